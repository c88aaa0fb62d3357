"""Secret scans: base patterns, and dictionary-primed zstandard novelty.

A candidate is a run of key characters with letters and digits near a
sensitive word; of an assignment without spaces it is the value, and the name
is part of what it is near. It is measured by its marginal compressed bytes: a compressor
primed with an identifier dictionary compresses the surrounding text with and
without the candidate. What the dictionary and the surroundings explain costs
little; a random key costs most of its length and is reported.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{12,}")
_SENSITIVE = re.compile(r"pass|pwd|secret|token|key|auth|cred|bearer|private|signature|login|access", re.IGNORECASE | re.ASCII)
#: RE2 twins that pick the texts worth a closer look, in one linear pass each.
_LOOK = {"assign": r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "access": "AKIA[A-Z0-9]", "hex": "[0-9a-f]{16}",
         "novel": r"[A-Za-z+/_=.-][0-9]|[0-9][A-Za-z+/_=-]"}

#: Identifiers and code words that a key is compared with.
IDENTIFIERS = (
    "abstract args array assert async await boolean break buffer bytes callback case catch char class client config connection "
    "const constructor context continue count data database debug default define delete dict double else encode endpoint enum "
    "environment error event except export extends false field file filter final finally float for format from function get "
    "global handler hash header host http https identifier if implements import index init input instance int interface internal "
    "key lambda length list local localhost logger long main map message method module name namespace new none null number object "
    "option output package parameter parse password path pattern port prefix print private property protected public query read "
    "request response result return schema secret select self server session set size socket source static status string struct "
    "super switch system table target test this thread throw timeout timestamp token true try type undefined unicode update url "
    "user username uuid value variable vector version virtual void while with write www yield").split()
SURROUNDINGS = 160
REACH = 40
#: Reported from this share of its length in marginal bytes, and this many bytes.
NOVELTY = 0.6
LEAST_BYTES = 10


class Novelty:
    """Marginal compressed bytes of a string next to its surroundings."""

    def __init__(self, identifiers=IDENTIFIERS):
        primed = zstandard.ZstdCompressionDict(" ".join(identifiers).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._zip = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False)

    def bytes_of(self, candidate: str, before: str, after: str) -> int:
        around = f"{before}\n{after}\n".encode("utf-8", "surrogatepass")
        return len(self._zip.compress(around + candidate.encode())) - len(self._zip.compress(around))


def _base(text: str, kinds) -> list[tuple[int, int, str]]:
    out = []
    if "assign" in kinds:
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "access" in kinds:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if "hex" in kinds:
        out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return out


def _parts(start: int, value: str) -> list[tuple[int, int]]:
    """Spans of a candidate's parts between its inner '='; padding belongs to the last."""
    body = value.rstrip("=")
    cuts = [-1, *(i for i, c in enumerate(body) if c == "=")]
    return [(start + a + 1, start + b) for a, b in zip(cuts, [*cuts[1:], len(value)])] if len(cuts) > 1 else []


def _is_novel(text: str, s: int, e: int, novelty: Novelty) -> bool:
    value = text[s:e]
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    before = text[max(0, s - SURROUNDINGS):s]
    if not _SENSITIVE.search(before[-REACH:]):
        return False
    return (n := novelty.bytes_of(value, before, text[e:e + SURROUNDINGS])) >= LEAST_BYTES and n >= NOVELTY * len(value)


def _novel(text: str, base, novelty: Novelty) -> list[tuple[int, int, str]]:
    """An assignment's parts are measured each, with its name as their context; where none is novel, the whole."""
    out, taken = [], sorted(base)
    for m in _CANDIDATE.finditer(text):
        s, e = m.span()
        if any(s < y and x < e for x, y, _ in taken):
            continue
        parts = [(a, b) for a, b in _parts(s, m.group()) if _CANDIDATE.fullmatch(text, a, b) and _is_novel(text, a, b, novelty)]
        out += [(a, b, "novel") for a, b in parts or ([(s, e)] if _is_novel(text, s, e, novelty) else [])]
    return out


def _joined(found) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def scan(docs: DataFrame, identifiers=IDENTIFIERS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts, base_sha256, spans.

    A span is ``kind:start:end`` in code points, of the whole match. A null or
    empty text has none; its base_sha256 is that of an empty string. Novel
    spans never overlap base ones.
    """
    fields = ["n_assign", "n_access", "n_hex"]

    def run(batches):
        novelty = Novelty(identifiers)
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            flags = {k: pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False) for k, p in _LOOK.items()}
            any_flag = flags["assign"] | flags["access"] | flags["hex"] | flags["novel"]
            n = {k: [0] * len(texts) for k in KINDS}
            sha, spans = [hashlib.sha256(b"").hexdigest()] * len(texts), [""] * len(texts)
            for i in any_flag.nonzero()[0].tolist():
                text = texts[i].as_py()
                found = _base(text, {k for k in KINDS if flags[k][i]})
                more = _novel(text, found, novelty) if flags["novel"][i] else []
                for _, _, kind in found + more:
                    n[kind][i] += 1
                sha[i], spans[i] = hashlib.sha256(_joined(found).encode()).hexdigest(), _joined(found + more)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(n[k], pa.int64()) for k in KINDS[:3]), pa.array(sha), pa.array(spans), pa.array(n["novel"], pa.int64())],
                names=["doc_id", *fields, "base_sha256", "spans", "n_novel"])

    kept = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = kept.select("doc_id").schema
    for f in fields:
        schema = schema.add(f, "long")
    return kept.mapInArrow(run, schema.add("base_sha256", "string").add("spans", "string").add("n_novel", "long"))
