import random
import re

from tests.llm.conftest import clashing, prose, table
from tillroll.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def split(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(text, items, window):
    own, hit, found = split(text), set(), set()
    for item, item_text in items:
        words = split(item_text)
        size = min(window, len(words))
        for a in range(len(words) - size + 1 if size else 0):
            for i in range(len(own) - size + 1):
                if own[i : i + size] == words[a : a + size]:
                    hit.update(range(i, i + size))
                    found.add(item)
    return len(own), len(hit), sorted(found)


def check(spark, texts, items, **options):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    result = decontaminate.contaminated(clashing(table(spark, texts)), benchmark, **options)
    rows = result.withColumn("n", decontaminate.hit_words(result["contamination"])).orderBy("doc_id")
    named = [("" if i is None else str(i), t) for i, t in items]
    for row, text in zip(rows.collect(), texts, strict=True):
        own = row.contamination
        expected = brute(text, named, options.get("window", decontaminate.WINDOW))
        assert (own.n_words, row.n, own["items"]) == expected


def test_windows_as_by_brute_force(spark, odd_texts):
    items = [(k, prose(1000 + k, 25)) for k in range(12)]
    items += [(20, "Short one, two"), (21, None), (22, "***"), (23, "single"), (None, prose(77, 14))]
    items += [(24, "la la la la la la la la la la la la"), (3, prose(1003, 25)), (10, "Ü x ü")]
    texts = [*odd_texts[:9], *odd_texts[11:]]
    for k in range(12):
        words = prose(1000 + k, 25).split()
        texts.append(" ".join([prose(k, 6), *words[k % 6 : k % 6 + 8 + k % 5], prose(k + 50, 5)]))
    texts += ["SHORT\tone;TWO", "a single b", "la " * 40, "ü X Ü", prose(77, 14).upper()]
    check(spark, texts, items)


def test_blocks_of_items_give_the_same(spark):
    items = [(k, prose(k, 15)) for k in range(20)]
    texts = [f"{prose(k, 15)} {prose(k + 7, 15)}" for k in range(10)]
    check(spark, texts, items, block_bytes=300)


def test_random_words(spark):
    own = random.Random(4)

    def some(n):
        return " ".join(own.choices("abc", k=n))

    items = [(k, some(own.randint(1, 8))) for k in range(15)]
    check(spark, [some(own.randint(0, 60)) for _ in range(40)], items, window=4)


def test_no_items_and_no_rows(spark):
    check(spark, ["a b c"], [])
    check(spark, [], [(1, "a b c")])


def test_tables_take_little_memory():
    """A megabyte of items in 20 MB or less, whatever their size."""
    for n_words, n in ((25, 3000), (2000, 40), (4, 6000)):
        items = [(str(k), prose(k, n_words).encode()) for k in range(n)]
        size = sum(len(text) for _, text in items)
        tables = decontaminate.tables(items)
        assert size > 150_000 and sum(table.memory() for table in tables) <= 20 * size


def test_each_block_is_built_once_in_a_worker(monkeypatch):
    import pyarrow as pa

    from tillroll.llm import common

    built, original = [], decontaminate.tables
    monkeypatch.setattr(decontaminate, "tables", lambda items, window: built.append(items) or original(items, window))
    monkeypatch.setattr(decontaminate.F, "arrow_udf", lambda _: lambda function: function)
    monkeypatch.setattr(common, "_BUILT", {})

    class Value:
        def __init__(self, value):
            self.value = value

    blocks = [Value([(str(k), prose(k, 15).encode())]) for k in range(3)]
    searches = [decontaminate._searched(items, 10, k) for k, items in enumerate(blocks)]
    for batch in range(4):
        texts = pa.array([prose(batch % 3, 15).encode(), b"", None], pa.binary())
        found = [search(texts).to_pylist()[0]["items"] for search in searches]
        assert found == [[str(k)] if k == batch % 3 else [] for k in range(3)]
    assert len(built) == 3


def test_blocks_are_read_one_at_a_time(spark):
    items = [(k, prose(k, 15)) for k in range(20)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    blocks = decontaminate.item_blocks(benchmark, 300)
    assert iter(blocks) is blocks
    named = sorted(item for block in blocks for item, _ in block)
    assert named == sorted(str(k) for k in range(20))


def test_search_of_one_table_by_brute_force():
    own = random.Random(9)
    for _ in range(50):
        texts = [own.choices([b"a", b"b", b"c", b"d"], k=own.randint(3, 9)) for _ in range(4)]
        table_ = decontaminate.Table(3, [(str(k), words) for k, words in enumerate(texts)])
        doc, hits, items = own.choices([b"a", b"b", b"c", b"d"], k=40), [], set()
        table_.search(doc, hits, items)
        expected = {
            (i, str(k)) for k, words in enumerate(texts) for a in range(len(words) - 2) for i in range(38)
            if doc[i : i + 3] == words[a : a + 3]
        }
        assert {a for a, _ in hits} == {i for i, _ in expected} and items == {k for _, k in expected}
