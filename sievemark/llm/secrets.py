"""Secret scanning: fixed patterns, and sliding-window Shannon entropy over candidate strings.

Base spans, per kind leftmost and non-overlapping: `assign` (a credential name, an assignment sign and a value of 12 characters
or more), `access` (AKIA and capitals or digits, 18 or more in all), `hex` (16 or more lower-case hexadecimal digits).
`entropy` spans are added by the method: in every candidate string a window of fixed width slides over one character at a
time; the counts of the window are updated for the character that enters and the one that leaves, and with them the sum of
n log n from which the entropy follows. Windows at or above the threshold of the candidate's character class are hot; each
maximal run of overlapping hot windows is a span. The allow-list suppresses whole candidates that are UUIDs or numbers, spans
all of whose segments (between separators) are words, short numbers, or say that they are placeholders. A word is
letters of one case, perhaps capitalised, or such words run together as in CamelCase: a secret of lower-case letters alone
cannot be told from a long word by its entropy, one of mixed letters can.

Defined results. Null text is empty. An empty text has no spans. Repeated rows are scanned one by one. doc_id passes through, null too. Other columns are not read. Spans count code points, end exclusive, and are ordered by start, then kind as listed.

At scale: one pass over the texts without a shuffle; the work is linear in the text, and whole texts are scanned.
"""

from __future__ import annotations

import hashlib
import math
import re

from pyspark.sql import DataFrame

from .common import over_batches

# Fixed patterns.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
KINDS = ("assign", "access", "hex", "entropy")

#: Characters of a window.
WIDTH = 20
#: Least entropy, in bits a character, of a hot window, by the candidate's character class.
THRESHOLDS = {"hex": 3.0, "letters": 3.8, "alphanumeric": 3.6, "base64": 3.7}
#: Whole candidates that are well known or structured rather than secret.
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"),  # UUID
    re.compile(r"[0-9+_=/-]+"),  # numbers, dates, rules
)
SEPARATOR = re.compile(r"[_/=+-]+")
ALLOWED_SEGMENT = re.compile(r"(?:[A-Za-z]?[a-z]*|[A-Z]+|[A-Za-z]?[a-z]+(?:[A-Z][a-z]+[a-z])*[A-Z]?)(?:[0-9]{1,4})?")
PLACEHOLDER = re.compile(r"example|placeholder|changeme|your", re.IGNORECASE)
_TERM = [0.0] + [n * math.log2(n) for n in range(1, WIDTH + 1)]


def character_class(candidate: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", candidate):
        return "hex"
    return "letters" if candidate.isalpha() else "alphanumeric" if candidate.isalnum() else "base64"


def allowed(candidate: str, start: int, end: int) -> bool:
    """Whether the allow-list suppresses this span of a candidate."""
    at = 0
    for m in [*SEPARATOR.finditer(candidate), None]:
        stop = m.start() if m else len(candidate)
        if at < end and start < stop and not ALLOWED_SEGMENT.fullmatch(candidate, at, stop) and not PLACEHOLDER.search(candidate, at, stop):
            return False
        at = m.end() if m else stop
    return True


def hot_spans(candidate: str, threshold: float, width: int = WIDTH) -> list[tuple[int, int]]:
    """Maximal unions of overlapping windows whose entropy reaches the threshold."""
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    limit = math.log2(width) - threshold + 1e-9
    for i, c in enumerate(candidate):
        n = counts.get(c, 0)
        total += _TERM[n + 1] - _TERM[n]
        counts[c] = n + 1
        if i >= width:
            gone = candidate[i - width]
            n = counts[gone]
            total += _TERM[n - 1] - _TERM[n]
            counts[gone] = n - 1
        if i >= width - 1 and total / width <= limit:
            start = i - width + 1
            if spans and spans[-1][1] >= start:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, by start and then kind."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(name in low for name in ASSIGN_NAMES):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    for m in CANDIDATE.finditer(text):
        word = m[0]
        if ALLOWED_SEGMENT.fullmatch(word) or any(x.fullmatch(word) for x in ALLOWED):
            continue
        found += [(m.start() + a, m.start() + b, 3) for a, b in hot_spans(word, THRESHOLDS[character_class(word)]) if not allowed(word, a, b)]
    found.sort(key=lambda x: (x[0], x[2], x[1]))
    return [(a, b, KINDS[k]) for a, b, k in found]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans and the matched strings of every row."""

    def rows(batch: list[dict]) -> list[dict]:
        out = []
        for row in batch:
            spans = scan(row["text"])
            base = [s for s in spans if s[2] != "entropy"]
            count = [sum(s[2] == kind for s in spans) for kind in KINDS]
            out.append({"doc_id": row["doc_id"], "n_assign": count[0], "n_access": count[1], "n_hex": count[2], "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(spans), "n_entropy": count[3]})
        return out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return over_batches(docs.select("doc_id", "text"), rows, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long")


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every maximal run of overlapping spans replaced by the mark."""
    out, at = [], 0
    runs: list[list[int]] = []
    for start, end, _ in scan(text):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    if not runs:
        return text
    for start, end in runs:
        out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]


def redacted(docs: DataFrame) -> DataFrame:
    """All rows and columns of docs, texts redacted, n_chars (where it is there) counted anew for the changed ones."""
    import pyarrow as pa

    at = docs.columns.index("text")
    sized = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [redact(t) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if sized is not None:
                columns[sized] = pa.array([n if a == b else len(b) for n, a, b in zip(columns[sized].to_pylist(), old, new, strict=True)], batch.schema.field(sized).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
