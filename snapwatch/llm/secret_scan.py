"""Secret scans: fixed patterns, and strings that a tokenizer's vocabulary can hardly shorten."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapwatch.llm.tables import slices

# Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")

# The patterns of the first three kinds. Letters of the keywords count in either case, ASCII only.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_CHARS, ACCESS_CHARS = 6, 20

# Strings that may be random, and how few characters a token may hold on average: prose has four and more,
# random letters and digits about one and a half.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
CHARS_PER_TOKEN = 2.2
_DIGIT, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
# Known digests and identifiers, which look random and are no secrets.
KNOWN = re.compile(
    r"""(?i:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}  # MD5 and SHA digests
    |sha(1|224|256|384|512)-[A-Za-z0-9+/]+=*                                                # subresource integrity
    |[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}                           # UUID
    |[0-9a-hjkmnp-tv-z]{26}                                                                 # ULID
    |[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9]*Z?)?(-[0-9-]+)?                                      # dates
    |[0-9+/_=-]+)""",  # numbers: phones, cards, books
    re.VERBOSE,
)
# An account number: a country, two check digits and an account, which together have the remainder 1.
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")
# Long runs are measured in parts, as a tokenizer's time on one run may grow faster than the run.
PART = 256

LEAST_CHARS, LEAST_PART = 16, 4

SPANS = "array<struct<kind:string,start:long,end:long>>"


def token_counter(path: str | None = None) -> Callable[[str], int]:
    """How many tokens a text has under a tiktoken vocabulary file."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
    encoding = tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


_PARTS = re.compile(r"[A-Za-z0-9]+")
_KNOWN_PARTS = re.compile(r"(?<![A-Za-z0-9])(?:[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[A-Za-z0-9]+)(?![A-Za-z0-9])")


def _known(word: str) -> bool:
    """Whether a string is a known digest, identifier, date or number."""
    if KNOWN.fullmatch(word):
        return True
    return bool(IBAN.fullmatch(word)) and int("".join(str(int(c, 36)) for c in word[4:] + word[:4])) % 97 == 1


def _random(word: str, count_tokens: Callable[[str], int]) -> bool:
    """Whether a string of letters and digits is long enough and gives few characters per token.

    What joins its parts, very short parts and numbers give few characters per token in any text, and don't count.
    """
    if len(word) < LEAST_CHARS or not (_DIGIT.search(word) and _LETTER.search(word)):
        return False
    parts = [p for p in _PARTS.findall(word) if len(p) >= LEAST_PART and not p.isdigit()]
    chars = sum(map(len, parts))
    tokens = sum(count_tokens(p[i : i + PART]) for p in parts for i in range(0, len(p), PART))
    return 2 * chars >= LEAST_CHARS and chars < CHARS_PER_TOKEN * tokens


def find_spans(text: str, count_tokens: Callable[[str], int]) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind; kinds are searched independently."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    base = sorted(s[1:] for s in found)
    for run in RUN.finditer(text):
        if any(start < run.end() and run.start() < end for start, end in base):
            continue  # the patterns have it already
        word, at = run.group(), run.start()
        if _known(word):
            continue
        # A part that is known is nobody's secret, whatever it is joined to; what is left is judged.
        held = [(m.start(), m.end()) for m in _KNOWN_PARTS.finditer(word) if _LETTER.search(m.group()) and _known(m.group())]
        edges = [0, *(e for span in held for e in span), len(word)]
        for start, end in zip(edges[::2], edges[1::2]):
            piece = word[start:end].strip("=/_+-")
            if not piece:
                continue
            start = word.index(piece, start)
            # Parts that are random by themselves, or else the whole of shorter ones.
            alone = [m.span() for m in _PARTS.finditer(piece) if not _known(m.group()) and _random(m.group(), count_tokens)]
            if not alone and _random(piece, count_tokens):
                alone = [(0, len(piece))]
            found += [("random", at + start + first, at + start + last) for first, last in alone]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _map_texts(docs: DataFrame, kept: list[Column], text: str, schema: str, work, path: str | None) -> DataFrame:
    """``kept`` columns and what ``work(text, spans)`` says of each text, in ``schema``'s last column."""
    *last, name = StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count_tokens = token_counter(path)
        for batch in slices(batches, "_text"):
            values = [work(t.as_py(), find_spans(t.as_py() or "", count_tokens)) for t in batch.column("_text")]
            columns = [batch.column(c) for c in last]
            if name == "spans":
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            else:
                kind = pa.string()
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, kind)], names=[*last, name])

    return docs.select(*kept, F.col(text).alias("_text")).mapInArrow(run, schema)


def scan_secrets(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end in code points, end exclusive), one row per input row.

    NULL and empty texts have no spans; repeated rows are scanned each; an empty table gives no rows. Whole texts
    are scanned. Other columns are not looked at.
    """

    def spans(body, found):
        return [{"kind": k, "start": s, "end": e} for k, s, e in found]

    return _map_texts(docs, [F.col(key).cast("long").alias("doc_id")], text, f"doc_id long, spans {SPANS}", spans, path)


def redact_secrets(docs: DataFrame, path: str | None = None, mark: str = "[REDACTED]", text: str = "text") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mark`` and ``n_chars``, where it is there, counted anew.

    All rows and columns stay; NULL texts stay NULL. Overlapping spans are replaced by one mark.
    """

    def cleaned(body, found):
        if not found:
            return body
        out, at = [], 0
        for _, start, end in found:
            if start >= at:
                out += [body[at:start], mark]
            at = max(at, end)
        return "".join([*out, body[at:]])

    others = [c for c in docs.columns if c != text]
    row = F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row")
    row_type = docs.select(row).schema["_row"].dataType.simpleString()
    done = _map_texts(docs, [row], text, f"_row {row_type}, _clean string", cleaned, path)
    chars = F.when(F.col("_clean").isNotNull(), F.length("_clean"))
    values = {c: F.col(f"_row.`{c}`") for c in others} | {text: F.col("_clean")}
    if "n_chars" in values:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.coalesce(chars.cast(kind), values["n_chars"])
    return done.select(*[values[c].alias(c) for c in docs.columns])


def listed(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans of these kinds, joined by commas, in their order."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

