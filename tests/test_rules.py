"""Row rules counted by the job that writes a table, and the rows that break them."""

import json

import pytest

from scenarios import OLD, PARAMS, buy, line, raw_of
from test_run import full_base, log_of
from tillroll.plans import publish, quality
from tillroll.plans.publish import QualityError, Run
from tillroll.reference_data import non_product_codes

BAD = [
    line(OLD, invoice="556001", date=None),
    buy(12001, None, "2011-03-01"),
    buy(9000, "556002", "2011-03-01"),
    buy(12001, "556003", "2011-03-01", country=None),
    buy(9001, "556004", "2011-03-01", country=None),
    buy(12002, "556005", "2011-03-01", code=" "),
    buy(12003, "55600", "2011-03-01"),
    buy(12004, "556006", "2011-03-01", code="lamp-9"),
    buy(12004, "556007", "2011-03-01 01:20:00", code="lamp-9"),
]


@pytest.fixture(scope="module")
def broken_run(spark, tmp_path_factory):
    lines = [*full_base(), *BAD]
    run = Run(spark, str(tmp_path_factory.mktemp("run")), "run", PARAMS)
    layers = publish.run_layers(raw_of(spark, lines), non_product_codes(spark), PARAMS, run)
    publish.build(layers)
    return run, layers, lines


def frames_of(run):
    return {
        "lines": run.table("clean_line"),
        "orders": run.table("orders"),
        "customer": run.table("customer"),
        "churn_validation": run.table("churn_validation"),
        "churn_band": run.table("churn_band"),
        "cohorts": run.table("cohort_retention"),
        "clv_validation_customer": run.table("clv_validation_customer"),
        "clv_validation": run.table("clv_validation"),
        "params": PARAMS,
    }


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_counts_of_the_writing_job_are_those_of_a_pass(broken_run):
    run, _, _ = broken_run
    assert set(run.counted) == set(quality.table_rules(PARAMS))
    read = rows(quality.check_rules(**frames_of(run)))
    assert rows(quality.check_rules(**frames_of(run), counted=run.counted)) == read
    found = {(table, rule): n for table, rule, n in read if n}
    assert found["clean_line", "customer range"] == 2
    assert found["clean_line", "required columns are filled"] == 4
    assert found["clean_line", "invoice format"] == 1


def test_checks_of_the_writing_job_are_those_of_a_pass(spark, broken_run):
    run, layers, lines = broken_run
    log = log_of(spark, len(lines))
    counted = rows(publish.quality_of(layers, log))
    read = quality.check_quality(
        raw=layers.raw, load_log=log, lines=layers.clean_line, invoices=layers.invoices, orders=layers.orders,
        customer=layers.customer, cohorts=layers.cohort_retention, churn_validation=layers.churn_validation,
        params=PARAMS, overlap_from=layers.overlap_from,
    )
    assert counted == rows(read)
    assert run.counted["clean_line"].odd_lines == 3
    assert next(r[4:6] for r in counted if r[1] == "clean_unclassified_codes") == ("0", "2")


def scans(frame, table):
    return frame._jdf.queryExecution().executedPlan().toString().count(f"/{table}]")


def test_the_lines_are_read_less_often(spark, broken_run):
    run, layers, lines = broken_run
    counted = scans(publish.rules_of(layers), "clean_line")
    assert counted == scans(quality.check_rules(**frames_of(run)), "clean_line") - 1
    without_odd = {**run.counted}
    without_odd["clean_line"] = quality.Counted({}, run.counted["clean_line"].sides, 0)
    parts = [quality._clean_checks(layers.clean_line, PARAMS, x) for x in (None, without_odd["clean_line"])]
    assert [scans(part, "clean_line") for part in parts] == [1, 0]


def test_rows_that_break_a_rule_are_listed_with_its_name(broken_run):
    run, _, _ = broken_run
    listed = run.reject()
    found = run.table("rejected_rows").collect()
    assert listed == len(found)
    lines = {}
    for row in found:
        if row.table == "clean_line":
            lines[json.loads(row.key)["source_row"]] = row.rules
    clean = {r.source_row: r for r in run.table("clean_line").collect()}
    said = {(clean[i].invoice, clean[i].customer_id): rules for i, rules in lines.items()}
    assert said["556001", clean[min(lines)].customer_id] == ["required columns are filled"]
    assert said["556002", 9000] == ["customer range"]
    assert said["556004", 9001] == ["customer range", "required columns are filled"]
    assert said["55600", 12003] == ["invoice format"]
    totals = run.counted["clean_line"].violations
    for rule, n in totals.items():
        assert n == sum(rule in rules for rules in lines.values()), rule


def test_a_refused_run_says_where_its_rows_are(spark, tmp_path):
    lines = [*full_base(), BAD[2]]
    with pytest.raises(QualityError, match=r"rows listed in .*/rejected_rows") as error:
        publish.process(raw_of(spark, lines), non_product_codes(spark), log_of(spark, len(lines)), PARAMS, str(tmp_path))
    place = str(error.value).rsplit(" ", 1)[1]
    found = spark.read.parquet(place).collect()
    assert {(r.table, tuple(r.rules)) for r in found} == {("clean_line", ("customer range",))}


def test_a_good_run_lists_nothing(spark, tmp_path):
    lines = full_base()
    run = publish.process(raw_of(spark, lines), non_product_codes(spark), log_of(spark, len(lines)), PARAMS, str(tmp_path))
    assert run.reject() == 0
    assert not (tmp_path / "runs" / run.run_id / "rejected_rows").exists()


def test_keys_with_nulls_and_empty_tables(spark):
    rules = quality.TableRules("t", ("a", "b"), [("b is even", quality.F.col("b") % 2 == 0)], ("a",))
    frame = spark.createDataFrame([("x", 1), (None, 2), ('q"', None), ("y", 4)], "a string, b int")
    assert rows(quality.rejected_rows(rules, frame)) == [
        ("t", '{"a":"x","b":1}', ["b is even"]),
        ("t", '{"a":null,"b":2}', ["required columns are filled"]),
    ]
    assert rows(quality.rejected_rows(rules, frame.limit(0))) == []
