"""Secret scanning: Aho-Corasick keyword prefilter, anchored patterns, embedded checksums.

One automaton pass over a text finds the keywords that any kind needs; each kind's pattern is
then tried only at the place of a hit, so ordinary text costs a single linear pass.  Runs of
hexadecimal digits have no keyword and are found by one possessive scan.

Base kinds: ``assign`` (a named credential with a value of 12 or more characters), ``access``
(an access key id) and ``hex`` (a run of 16 or more digits).  The method adds ``checked``: tokens
whose last six characters are the base-62 CRC-32 of their body; a token whose checksum does not
match is not reported.

Offsets are code points, ends exclusive.  Null and empty texts have no spans; a null id stays
null; repeated rows are scanned once each; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.batches import slices

# Keywords and patterns of the base kinds, and prefixes of checksummed tokens.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}+")
CHECKED = re.compile(rb"(?:gh[pousr]|npm)_([0-9A-Za-z]{36})(?![0-9A-Za-z])")
KINDS = ("assign", "access", "hex", "checked")
BASE = ("assign", "access", "hex")
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SPANS = "array<struct<kind string, start long, end long, value string>>"


def base62(value: int, width: int = 6) -> str:
    out = ""
    for _ in range(width):
        value, digit = divmod(value, 62)
        out = DIGITS[digit] + out
    return out


def checksum_holds(body: bytes) -> bool:
    """The last six of 36 characters are the CRC-32 of the first thirty in base 62."""
    return base62(zlib.crc32(body[:-6])) == body[-6:].decode()


def keyword_automaton():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for kind, words in (("assign", ASSIGN_WORDS), ("access", ("akia",)), ("checked", CHECKED_PREFIXES)):
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def scan(text: str, automaton) -> list[tuple[str, int, int, str]]:
    """All spans of one text by start, then kind in the order of KINDS."""
    raw = text.encode("utf-8", "surrogatepass")
    found: list[tuple[int, int, int]] = [(m.start(), 2, m.end()) for m in HEX.finditer(raw)]
    after = dict.fromkeys(KINDS, 0)
    # Keywords are ASCII, so matching bytes as Latin-1 finds them at their byte offsets.
    for last, (kind, width) in automaton.iter(raw.lower().decode("latin-1")):
        at = last + 1 - width
        if at < after[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(raw, at):
                after[kind] = m.end()
                if m.end(1) - m.start(1) >= 12:
                    found.append((at, 0, m.end()))
        elif kind == "access":
            if m := ACCESS.match(raw, at):
                after[kind] = m.end()
                if m.end() - at >= 18:
                    found.append((at, 1, m.end()))
        elif (at == 0 or not raw[at - 1 : at].isalnum()) and (m := CHECKED.match(raw, at)) and checksum_holds(m[1]):
            after[kind] = m.end()
            found.append((at, 3, m.end()))
    if not found:
        return []
    found.sort()
    place = places(raw, sorted({p for a, _, b in found for p in (a, b)})) if len(raw) != len(text) else None
    return [(KINDS[k], place[a] if place else a, place[b] if place else b, raw[a:b].decode("ascii")) for a, k, b in found]


def places(raw: bytes, offsets: list[int]) -> dict[int, int]:
    """The code points before each of ascending byte offsets, in one pass."""
    out, at, n = {}, 0, 0
    for offset in offsets:
        n += len(raw[at:offset].decode("utf-8", "surrogatepass"))
        at = offset
        out[offset] = n
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of (kind, start, end, value)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = keyword_automaton()
        for batch in slices(batches):
            spans = [
                [{"kind": k, "start": a, "end": b, "value": v} for k, a, b, v in scan(t, automaton)] if t else []
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, f"doc_id long, spans {SPANS}")


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark`` (overlapping spans by one) and ``n_chars`` renewed.

    All columns and rows stay; null texts stay null.
    """
    names = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = keyword_automaton()
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            counts = batch.column("n_chars").to_pylist() if "n_chars" in names else []
            for i, text in enumerate(texts):
                spans = scan(text, automaton) if text else []
                if not spans:
                    continue
                parts, end = [], 0
                for _, a, b, _ in spans:
                    if a >= end:
                        parts += [text[end:a], mark]
                    end = max(end, b)
                texts[i] = "".join(parts) + text[end:]
                if counts:
                    counts[i] = len(texts[i])
            columns = [
                pa.array(texts, batch.schema.field(n).type) if n == "text" else pa.array(counts, batch.schema.field(n).type) if n == "n_chars" else batch.column(n)
                for n in names
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(work, docs.schema)
