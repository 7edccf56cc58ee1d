"""Secret scans: fixed patterns, and long runs of which a BPE vocabulary makes unusually short tokens."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rows, sha256_hex, sliced, tidied

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Runs that the ratio test looks at.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Words that an assignment must hold, for a look before the full pattern.
WORDS = ("passw", "secret", "token", "api")
#: Digests in hex (MD5, SHA-1, SHA-2) and UUIDs are known digests, not keys.
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64}|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12})\Z")
#: Characters per token under which a run counts as random.
RATIO = 2.2
SEPARATORS = "_/=+-"
DIGEST_NAME = re.compile(r"(?:sha|md)\d{1,3}", re.I)

Span = tuple[int, int, str]


@lru_cache(2)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
    return tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[Span]:
    """(begin, end, kind) of the fixed patterns in code points, in order of begin, then of kind."""
    low = text.lower()
    found = []
    if any(w in low for w in WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _wordy(parts: list[str], encoding: tiktoken.Encoding, ratio: float) -> bool:
    """Whether letters of one case (or capitalized) have together the ratio of words; numbers and single letters don't count."""
    if not all(re.fullmatch(r"(?:[A-Za-z]?[a-z]*|[A-Z]+|\d{1,8})", p) for p in parts):
        return False
    words = [p for p in parts if len(p) > 1 and not p[0].isdigit()]
    return sum(map(len, words)) >= ratio * sum(len(encoding.encode_ordinary(p)) for p in words)


def is_identifier(run: str, encoding: tiktoken.Encoding, ratio: float = RATIO) -> bool:
    """Numbers, and words of a high ratio of their own that _ - or / join, by their form."""
    if run.isdigit():
        return True
    parts = re.split(r"[_/=+-]+", run)
    return len(parts) > 1 and _wordy(parts, encoding, ratio)


def is_random(run: str, encoding: tiktoken.Encoding, ratio: float = RATIO) -> bool:
    """Fewer characters per token than ``ratio``, and neither a known digest nor an identifier."""
    return len(run) < ratio * len(encoding.encode_ordinary(run)) and not DIGEST.match(run) and not is_identifier(run, encoding, ratio)


def random_spans(text: str, encoding: tiktoken.Encoding, ratio: float = RATIO, base: list[Span] | tuple = ()) -> list[Span]:
    """Random runs; of those that ``base`` spans cover in part, what these leave over."""
    found = []
    for m in RUN.finditer(text):
        own = [x for x in base if x[0] < m.end() and m.start() < x[1]]
        if own:
            found += _left_over(text, m, own, encoding, ratio)
        elif is_random(m[0], encoding, ratio):
            found.append((m.start(), m.end(), "random"))
    return found


def _left_over(text: str, m: re.Match, own: list[Span], encoding: tiktoken.Encoding, ratio: float) -> list[Span]:
    """Parts that are random by themselves, and in a random run all that adjoins an access or hex span, save for names
    and words that a separator sets off.  A name before an assignment is no part of what is assigned."""
    found, at, whole = [], m.start(), is_random(m[0], encoding, ratio)
    before = None
    for a, b, kind in [*own, (m.end(), m.end(), None)]:
        if at < a:
            part = text[at:a]
            joined = before in ("access", "hex") and part[0] not in SEPARATORS or kind in ("access", "hex") and part[-1] not in SEPARATORS
            near = before in ("access", "hex") or kind in ("access", "hex")
            if RUN.fullmatch(part) and is_random(part, encoding, ratio) or whole and near and (joined or not is_name(part, encoding, ratio)):
                found.append((at, a, "random"))
        if b >= at:
            at, before = b, kind
    return found


def is_name(part: str, encoding: tiktoken.Encoding, ratio: float = RATIO) -> bool:
    """Only separators, names of digests, and words each of a high ratio."""
    return all(not p or DIGEST_NAME.fullmatch(p) or p.isalpha() and _wordy([p], encoding, ratio) and len(p) > 1 for p in re.split(r"[_/=+-]+", part))


def scan_text(text: str, encoding: tiktoken.Encoding, ratio: float = RATIO) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: those, the random runs that no base span overlaps, and what base spans leave of others."""
    base = base_spans(text)
    return base, sorted(base + random_spans(text, encoding, ratio, base), key=lambda x: (x[0], KINDS.index(x[2])))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", id_col: str = "doc_id", ratio: float = RATIO) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` per input row, in one map over texts.

    A null or empty text has no spans (the digest is that of no bytes, ``spans`` is empty);
    repeated rows each give a row; other columns play no part.  Whole texts are searched.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        encoding = _encoding(vocabulary, pattern)
        for b in sliced(batches):
            rows = []
            for t in b.column(1).to_pylist():
                base, all_spans = scan_text(t or "", encoding, ratio)
                kinds = [k for _, _, k in all_spans]
                rows.append((*map(kinds.count, KINDS), sha256_hex(written(base).encode()), written(all_spans)))
            n = [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([b.column(0), *n, *(pa.array([r[i] for r in rows], pa.string()) for i in (4, 5))], ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(tidied(run), f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")


def redact(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ratio: float = RATIO) -> DataFrame:
    """The same rows and columns, every span of ``text`` replaced by ``<kind>``; null texts stay null.

    ``n_chars``, where there, follows the text."""

    def clean(t: str | None, encoding: tiktoken.Encoding) -> str | None:
        if not t:
            return t
        out, done = [], 0
        for a, b, k in scan_text(t, encoding, ratio)[1]:
            if a >= done:
                out += [t[done:a], f"<{k}>"]
            done = max(done, b)
        return "".join([*out, t[done:]])

    at = df.columns.index(text)
    length = df.columns.index("n_chars") if "n_chars" in df.columns else None

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        encoding = _encoding(vocabulary, pattern)
        for b in sliced(batches):
            new = [clean(t, encoding) for t in b.column(at).to_pylist()]
            columns = [*b.columns]
            columns[at] = pa.array(new, b.schema.field(at).type)
            if length is not None:
                columns[length] = pa.array([None if t is None else len(t) for t in new], b.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)
        _encoding.cache_clear()  # what follows in a pipeline has no use for it

    return df.mapInArrow(tidied(run), df.schema)
