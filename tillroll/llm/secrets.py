"""Secret scans: three base patterns, and novelty against a primed zstandard compressor.

A candidate is a long token shortly after a sensitive word; all in reach are measured. Its novelty
is what it adds to the compressed size of the code before it, with a dictionary of identifiers and
that code as prefix: names and repeated text cost little, random strings nearly all their bytes.
Candidates that stay incompressible are reported. What the base patterns find is measured too, so
that a value that is a name can be told from one that is a key; it stays reported either way.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import own_names

KINDS = ("assign", "access", "hex", "novel")

_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

#: A sensitive word, and the candidates that begin within REACH characters of its end.
_SENSITIVE = re.compile(
    r"(?i:passw(?:or)?d|passphrase|secret|token|api_?key|credential|private[ _-]?key|access[ _-]?key|auth)",
    re.ASCII,
)
#: Characters of a candidate. From LENGTH on one of names' and keys' characters alone will do; a
#: shorter one, or one with other symbols, needs letters and digits.
LENGTH, LEAST_LENGTH = 16, 12
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=.!$%@~#^&*-]{{{LEAST_LENGTH},}}")
_PLAIN = re.compile(rf"[A-Za-z0-9+/_=.-]{{{LENGTH},}}")
_MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])")
#: Marks that end a sentence or a phrase rather than a key.
_CLOSING = "!.*&^~#"
REACH = 48
#: Characters of surrounding text that prime the compressor.
AROUND = 512
#: Marginal compressed bytes for each byte of a candidate from which on it is reported.
LEAST_NOVELTY = 0.75
#: From 64 bytes on zstandard codes the literals of a block by entropy, and a random string of few
#: different letters gets cheap by its length. Longer candidates go in as blocks of PIECE at most.
PIECE = 60
#: Bytes of the header that each block has.
BLOCK_HEADER = 3

#: Identifiers that code around credentials uses.
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key secret_key private_key "
    "public_key credential credentials authorization authentication bearer client_id client_secret "
    "username user_name account database connection_string host hostname port endpoint region "
    "bucket config configuration settings environment variable default value string example "
    "sample placeholder changeme your_token_here your_api_key your_password_here undefined null "
    "none true false import return function class public static final const export request "
    "response header headers content-type application/json https://www.example.com/ http://localhost "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ "
)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns, by start, then kind. Positions are code points."""
    found: list[Span] = []
    for match in _ASSIGN.finditer(text):
        if len(match[1]) >= 12:
            found.append(("assign", match.start(), match.end()))
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def novelty(candidate: str, around: str) -> float:
    """Compressed bytes that a candidate adds for each of its bytes, headers of blocks left out."""
    known = zstandard.ZstdCompressionDict(
        (IDENTIFIERS + around).encode(errors="replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    compressor = zstandard.ZstdCompressor(
        level=9, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    own = candidate.encode()
    empty = len(compressor.compress(b""))
    if len(own) <= PIECE:
        return (len(compressor.compress(own)) - empty) / len(own)
    blocks = compressor.compressobj(size=len(own))  # each block still refers to all before it
    piece = -(-len(own) // -(-len(own) // PIECE))
    cost = -empty
    for at in range(0, len(own), piece):
        cost += len(blocks.compress(own[at : at + piece])) - BLOCK_HEADER
        cost += len(blocks.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK))
    return (cost + len(blocks.flush())) / len(own)


def _merged(spans_: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint runs that spans cover, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted((start, end) for _, start, end in spans_):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _candidate(text: str, at: int, until: int) -> tuple[int, int, bool] | None:
    """The next run of candidate characters that begins at `at` or after and shows its first
    LEAST_LENGTH before `until`: start, end, and whether it may be a key."""
    match = _CANDIDATE.search(text, at, until)
    if not match:
        return None
    match = _CANDIDATE.match(text, match.start())  # past the cut as well
    start, end = match.span()
    end = start + len(match[0].rstrip(_CLOSING))
    own = text[start:end]
    return start, max(end, start + 1), bool(_PLAIN.fullmatch(own) or len(own) >= LEAST_LENGTH and _MIXED.match(own))


def novel_spans(text: str, taken: list[Span], least: float = LEAST_NOVELTY) -> list[Span]:
    """Candidates with a novelty of at least `least` that touch no span already taken, nor each
    other: of two that overlap the one that begins first is reported."""
    found: list[Span] = []
    starts, ends = _merged(taken)
    seen: set[int] = set()
    for word in _SENSITIVE.finditer(text):
        at = max(word.end(), found[-1][2] if found else 0)
        while candidate := _candidate(text, at, word.end() + REACH + LEAST_LENGTH):
            start, at, may_be = candidate
            if start in seen or not may_be:
                continue
            seen.add(start)
            before = bisect_right(starts, at - 1) - 1
            if before >= 0 and ends[before] > start:
                continue
            if novelty(text[start:at], _around(text, start, at)) >= least:
                found.append(("novel", start, at))
    return found


def _around(text: str, start: int, end: int) -> str:
    return text[max(0, start - AROUND) : start] + " " + text[end : end + AROUND]


def spans(text: str | None, least: float = LEAST_NOVELTY) -> list[Span]:
    base = base_spans(text or "")
    return ordered(base + novel_spans(text or "", base, least))


def novelties(text: str, found: list[Span]) -> list[float]:
    """The novelty of each span, of an assignment that of its value."""
    out = []
    for kind, start, end in found:
        if kind == "assign":
            start = _ASSIGN.match(text, start).start(1)
        out.append(novelty(text[start:end], _around(text, start, end)))
    return out


RESULT = "array<struct<kind:string,start:int,end:int,novelty:double>>"
_RESULT = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())])
)


def secrets(
    docs: DataFrame,
    out: str = "secrets",
    least_novelty: float = LEAST_NOVELTY,
    novelty_out: str | None = None,
) -> DataFrame:
    """docs with an array of spans (kind, start, end), by start, then kind as in KINDS; if asked for,
    with an array of their novelties too, of an assignment that of its value.

    Positions count code points of the whole text, the end is exclusive. Null and empty texts have
    no span. Spans of the base patterns may overlap those of another kind, as the patterns say;
    novel ones overlap none, and of two candidates the first is reported. Texts of any length are
    searched whole, in time that grows with the text and its spans. Rows are independent of each
    other, so repeated ones are treated alike. Columns named as the new ones are replaced; all others pass
    through.
    """

    def rows(text: str) -> list[dict]:
        own = spans(text, least_novelty)
        measured = zip(own, novelties(text, own), strict=True)
        return [{"kind": k, "start": a, "end": b, "novelty": x} for (k, a, b), x in measured]

    @F.arrow_udf(RESULT)
    def found(texts: pa.Array) -> pa.Array:
        return pa.array((rows(x.as_py() or "") for x in texts), _RESULT)

    (own,) = own_names("found")
    fields = lambda s: F.struct(s["kind"], s["start"], s["end"])
    columns = {out: F.transform(own, fields)}
    if novelty_out:
        columns[novelty_out] = F.col(own)["novelty"]
    return docs.withColumn(own, found(F.col("text"))).withColumns(columns).drop(own)


def of_kind(spans_: F.Column, *kinds: str) -> F.Column:
    return F.filter(spans_, lambda span: span["kind"].isin(*kinds))


def as_text(spans_: F.Column) -> F.Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
