import re
from collections import defaultdict

from tests.llm.conftest import clashing, prose, table
from tillroll.llm import sentences

END = re.compile(r"(?:[.!?]+[^0-9A-Za-z\s\u0080-\U0010ffff]*(?=[ \t\n\r\f\v])|\n)[ \t\n\r\f\v]*")


def pieces(text):
    out, at = [], 0
    for match in END.finditer(text or ""):
        out.append(text[at : match.end()])
        at = match.end()
    return out + ([text[at:]] if text and at < len(text) else [])


def gone(rows, size, least):
    """doc_id to the numbers of removed sentences."""
    places = defaultdict(list)
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        own = pieces(text)
        words = [re.findall(rb"[0-9a-z\x80-\xff]+", p.encode().lower()) for p in own]
        real = [i for i, w in enumerate(words) if w]
        for k, i in enumerate(real):
            for stop in range(k + size, len(real) + 1):
                span = [w for j in real[k:stop] for w in words[j]]
                if len(span) >= least:
                    places[tuple(span)].append((doc_id, i, real[stop - 1] + 1))
                    break
    out = defaultdict(set)
    for found in places.values():
        for doc_id, a, b in found[1:]:
            out[doc_id].update(range(a, b))
    return out


def test_sentences_as_by_brute_force(spark, odd_texts):
    shared = [prose(700 + k, 60) for k in range(5)]
    texts = [*odd_texts[:9], *odd_texts[11:]]
    for k in range(30):
        texts.append(f"{prose(k, 15)}\n{shared[k % 5]} {prose(k + 90, 8)} {shared[(k * 3) % 5][20:]}")
    texts += [texts[-1], "Hi. Hi. Hi. " * 30, 'He said "no." Then he left!) And so on?\n\nEnd.']
    docs = clashing(table(spark, texts))
    for size, least in ((3, 20), (2, 5), (1, 1)):
        removed = gone(list(enumerate(texts)), size, least)
        for row in sentences.dedup_spans(docs, size, least).collect():
            own, cut = pieces(texts[row.doc_id]), removed[row.doc_id]
            assert row.kept == "".join(p for i, p in enumerate(own) if i not in cut)
            assert (row.n_sentences, row.n_removed) == (len(own), len(cut))
            text = texts[row.doc_id] or ""
            assert "".join(text[s.start : s.end] for s in row.spans) == "".join(own[i] for i in sorted(cut))


def test_the_first_occurrence_stays(spark):
    passage = prose(31, 60)
    docs = table(spark, [f"{prose(k, 9)} {passage} {prose(k + 20, 9)}" for k in range(8)], ids=list(range(7, -1, -1)))
    rows = {r.doc_id: r.n_removed for r in sentences.dedup_spans(docs).collect()}
    assert rows.pop(0) == 0 and min(rows.values()) >= 3


def test_clean_and_no_rows(spark):
    docs = table(spark, [prose(k, 80) for k in range(30)])
    assert sentences.dedup_spans(docs).filter("n_removed > 0").count() == 0
    assert sentences.dedup_spans(table(spark, [])).collect() == []


def test_null_ids_come_last(spark):
    text = prose(3, 60)
    rows = sentences.dedup_spans(table(spark, [text, text], ids=[None, 4])).collect()
    assert {r.doc_id: r.n_removed > 0 for r in rows} == {None: True, 4: False}


def gone_with_short_passages(rows):
    """As `gone`, with spans of two and of three sentences, long sentences, and short texts whole."""
    places = defaultdict(list)
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        own = pieces(text)
        words = [re.findall(rb"[0-9a-z\x80-\xff]+", p.encode().lower()) for p in own]
        real = [i for i, w in enumerate(words) if w]
        found = set()
        for k in range(len(real)):
            for least, fewest in ((20, 3), (20, 2), (50, 1)):
                for stop in range(k + fewest, len(real) + 1):
                    if sum(len(words[j]) for j in real[k:stop]) >= least:
                        found.add((k, stop, least))
                        break
        found = {
            (k, stop) for k, stop, least in found
            if least == 20 or all(stop < other for j, other, size in found if j == k and size == 20)
        }
        for k, stop in sorted(found) or ([(0, len(real))] if real else []):
            span = [w for j in real[k:stop] for w in words[j]]
            places[tuple(span)].append((doc_id, real[k], real[stop - 1] + 1))
    out = defaultdict(set)
    for found in places.values():
        for doc_id, a, b in found[1:]:
            out[doc_id].update(range(a, b))
    return out


def running(seed, n_words):
    """One sentence of n_words words."""
    return prose(seed, n_words).replace(".", "").lower() + "."


def test_short_passages_as_by_brute_force(spark, odd_texts):
    pair, long_one = f"{running(800, 14)} {running(801, 16)}", running(802, 53)
    texts = [*odd_texts[:9], *odd_texts[11:], long_one, long_one, running(803, 2320), running(803, 2320)]
    for k in range(12):
        texts += [f"{prose(k, 30)} {pair} {prose(k + 60, 30)}", f"{prose(k + 20, 30)}\n{long_one}"]
        texts += [f"{running(804, 9)} {running(805, 5)} {running(806, 4)}", f"{running(900 + k % 4, 3)}"]
        texts += [f"{running(950 + k % 3, 49)} {prose(k + 40, 30)}", f"{long_one} {prose(990, 6)}"]
    removed = gone_with_short_passages(list(enumerate(texts)))
    for row in sentences.dedup_spans(clashing(table(spark, texts))).collect():
        own, cut = pieces(texts[row.doc_id]), removed[row.doc_id]
        assert row.kept == "".join(p for i, p in enumerate(own) if i not in cut)
        assert (row.n_sentences, row.n_removed) == (len(own), len(cut))


def test_repeats_of_fewer_than_three_sentences_go(spark):
    pair, long_one = f"{running(1, 14)} {running(2, 16)}", running(3, 53)
    texts = [pair, pair, f"{prose(4, 30)}\n{long_one}", f"{long_one} {prose(5, 30)}", "Short text.", "Short text."]
    rows = {r.doc_id: r.n_removed for r in sentences.dedup_spans(table(spark, texts)).collect()}
    assert rows == {0: 0, 1: 2, 2: 0, 3: 1, 4: 0, 5: 1}


def test_no_passage_of_three_sentences_is_lost_to_shorter_spans(spark):
    passage = " ".join(running(seed, size) for seed, size in ((11, 15), (12, 6), (13, 5)))
    docs = table(spark, [f"{running(20 + k, 30)} {passage} {running(30 + k, 30)}" for k in range(2)])
    assert {r.doc_id: r.n_removed for r in sentences.dedup_spans(docs).collect()} == {0: 0, 1: 3}
