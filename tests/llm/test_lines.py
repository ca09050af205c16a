from collections import defaultdict

from tests.llm.conftest import clashing, prose, table
from tillroll.llm import lines

BLANK = " \t\x0b\f\r"


def brute(rows, least):
    """rows: (doc_id, text, source); texts without removed lines, by doc_id."""
    sites, first = defaultdict(set), {}
    for doc_id, text, source in sorted(rows):
        for pos, line in enumerate((text or "").split("\n")):
            own = line.strip(BLANK)
            if own:
                sites[own].add(source)
                first.setdefault(own, (doc_id, pos))
    out = {}
    for doc_id, text, _ in rows:
        kept = [
            line
            for pos, line in enumerate((text or "").split("\n"))
            if len(sites[line.strip(BLANK)] - {None}) < least
            or first[line.strip(BLANK)] == (doc_id, pos)
        ]
        out[doc_id] = None if text is None else "\n".join(kept)
    return out


def test_lines_as_by_hand(spark):
    common = ["Sign in", "All rights reserved.", "Share this"]
    rows = []
    for i in range(120):
        own = [prose(i, 6), common[i % 3], f"\t{common[(i + 1) % 3]} ", "", prose(i % 7, 4)]
        if i % 5 == 0:
            own.append(own[1])
        rows.append((i, "\n".join(own), f"s{i % 23}" if i % 11 else None))
    rows += [(200, None, "s1"), (201, "", "s2"), (202, "Sign in", "s3"), (203, "\n\n", "s3")]
    docs = table(spark, [r[1] for r in rows], sources=[r[2] for r in rows], ids=[r[0] for r in rows])
    for least in (2, 10, 23, 24):
        result = lines.dedup_lines(clashing(docs), least)
        assert result.columns[:-2] == clashing(docs).columns
        kept = {row.doc_id: row for row in result.collect()}
        expected = brute(rows, least)
        assert {i: row.text for i, row in kept.items()} == expected
        assert all(row.n_chars == (None if row.text is None else len(row.text)) for row in kept.values())


def test_hot_line_on_one_site_stays(spark):
    docs = table(spark, ["menu\n" + prose(i, 5) for i in range(60)], sources=["one"] * 60)
    assert lines.dedup_lines(docs, 2).filter("dedup_removed > 0").count() == 0


def test_odd_texts_and_no_rows(spark, odd_texts):
    docs = table(spark, odd_texts)
    assert [r.text for r in lines.dedup_lines(docs).orderBy("doc_id").collect()] == odd_texts
    assert lines.dedup_lines(table(spark, [])).collect() == []


def test_estimates_far_above_the_threshold(spark):
    """More sites than a sketch can list; near and far thresholds."""
    texts = [f"wide\nown {i}" for i in range(1500)]
    docs = table(spark, texts, sources=[f"site {i}" for i in range(1500)])
    for least, removed in ((100, 1499), (1500, 1499), (1501, 0)):
        result = lines.dedup_lines(docs, least)
        assert result.agg({"dedup_removed": "sum"}).first()[0] == removed
