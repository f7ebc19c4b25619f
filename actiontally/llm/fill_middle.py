"""Operator 13, fill-in-middle transformation by content-defined chunk memoization.

A text is cut between units: runs of ASCII letters, and every other character by itself. A rolling
hash over the last 32 bytes cuts each text into chunks that depend on the content alone, so copies
and shared passages give the same chunks wherever they stand. A chunk's boundary summary (its
characters, the units that start in it, whether it begins and ends with a letter) is worked out
once per task and remembered by the chunk's bytes. Units of a text are the sum over its chunks,
less one wherever a run of letters goes on across a chunk's end; the running sums tell in which
chunk a cut lies, and only that chunk is looked at again.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiontally.llm.common import joined_bytes, slices

SEED = 1
#: Of 100 documents, those left as they are, and of the others those with the suffix first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
#: Bytes that the rolling hash sees; a chunk ends where its top bits are zero (every 256 bytes or so)
#: or after so many bytes. A long run of one character so makes few chunks or many, never a wrong one.
WINDOW, CUT_BITS, CHUNK_MOST = 32, 8, 4096
#: Chunk bytes that a task remembers; when they are more, it starts anew.
MEMO_BYTES = 24 << 20
_GEAR = np.random.default_rng(13).integers(0, 1 << 32, 256, dtype=np.uint32)
_LETTER = np.array([0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A for c in range(256)])
_LEAD = np.array([c & 0xC0 != 0x80 for c in range(256)])


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes up to each position, by doubling the bytes seen."""
    h, width = _GEAR[data], 1
    while width < WINDOW:
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    return h


def chunk_bounds(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Positions at which each text's chunks begin, and its end."""
    cuts = np.flatnonzero(rolling(data) >> np.uint32(32 - CUT_BITS) == 0) + 1
    out = []
    for a, b, i, j in zip(starts.tolist(), ends.tolist(), np.searchsorted(cuts, starts + WINDOW), np.searchsorted(cuts, ends)):
        at = np.concatenate([[a], cuts[i:j], [b]]) if b > a else np.array([a])
        wide = np.diff(at)
        if len(wide) and wide.max() > CHUNK_MOST:
            at = np.unique(np.concatenate([at, *(np.arange(at[k], at[k + 1], CHUNK_MOST) for k in np.flatnonzero(wide > CHUNK_MOST))]))
        out.append(at)
    return out


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Where a unit starts, if a letter ahead of the first byte is not looked at."""
    letter = _LETTER[data]
    run = letter.copy()
    run[1:] &= ~letter[:-1]
    return run | (_LEAD[data] & ~letter)


class Summaries(dict):
    """Chunk -> characters << 32 | units << 2 | begins with a letter << 1 | ends with a letter.
    Texts of which the chunks' own bytes are the key are compared by those bytes."""

    size = 0

    def learn(self, chunks: list[bytes]) -> None:
        data, starts, ends = joined_bytes(chunks)
        letter = _LETTER[data]
        begins = unit_starts(data)
        begins[starts] = _LEAD[data[starts]]  # the chunk before is not its own
        count = lambda flag: np.add.reduceat(flag, starts, dtype=np.int64)
        found = count(_LEAD[data]) << 32 | count(begins) << 2 | letter[starts].astype(np.int64) << 1 | letter[ends - 1]
        self.update(zip(chunks, found.tolist()))
        self.size += len(data)

    def of(self, chunks: list[bytes]) -> np.ndarray:
        if self.size > MEMO_BYTES:
            self.clear()
            self.size = 0
        new = list({c for c in chunks if c not in self})
        for a in range(0, len(new), 4096):
            self.learn(new[a : a + 4096])
        return np.fromiter(map(self.__getitem__, chunks), dtype=np.int64, count=len(chunks))


class Text:
    """One text as chunk summaries: its number of units, and cuts by number."""

    def __init__(self, data: bytes, at: np.ndarray, found: np.ndarray):
        self.data, self.at = data, at
        first, last = found >> 1 & 1, found & 1
        self.joins = np.concatenate([[0], last[:-1] & first[1:]]) if len(found) else found
        self.units = np.concatenate([[0], np.cumsum((found >> 2 & 0x3FFFFFFF) - self.joins)])
        self.chars = np.concatenate([[0], np.cumsum(found >> 32)])
        self.n = int(self.units[-1])

    def cut(self, k: int) -> tuple[int, int]:
        """Byte and character position after the first ``k`` units: where unit ``k`` starts."""
        if k >= self.n:
            return len(self.data), int(self.chars[-1])
        c = int(np.searchsorted(self.units, k, side="right")) - 1
        a, b = int(self.at[c] - self.at[0]), int(self.at[c + 1] - self.at[0])
        piece = np.frombuffer(self.data, dtype=np.uint8, count=b - a, offset=a)
        begins = unit_starts(piece)
        begins[0] = _LEAD[piece[0]] and not self.joins[c]
        off = int(np.flatnonzero(begins)[k - int(self.units[c])])
        return a + off, int(self.chars[c]) + int(_LEAD[piece[:off]].sum())


def draws(key: object, seed: int) -> tuple[int, int, int, int]:
    """The four numbers that decide a document's cuts and form; a null id counts as empty."""
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return int(h[:8], 16), int(h[8:16], 16), int(h[16:24], 16), int(h[24:32], 16)


def transform(text: Text, key: object, seed: int) -> tuple[int, str, int | None, int | None, bytes]:
    one, two, three, four = draws(key, seed)
    data = text.data
    if not data or three % 100 >= 100 - PLAIN_PERCENT or any(m in data for m in MARKS):
        return text.n, "plain", None, None, data
    (a, chars), (b, upto) = (text.cut(k) for k in sorted((one % (text.n + 1), two % (text.n + 1))))
    p, s, m = MARKS
    if four % 100 < SPM_PERCENT:
        return text.n, "spm", chars, upto - chars, b"".join((s, data[b:], p, data[:a], m, data[a:b]))
    return text.n, "psm", chars, upto - chars, b"".join((p, data[:a], s, data[b:], m, data[a:b]))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """Per row the id, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Null text counts as empty, empty text is plain with no units. Rows that repeat an id are each
    worked on by themselves, with the same draws; a null id draws as an empty one. Texts of any
    length are taken whole. No rows: no rows. Other columns aren't read, whatever their names."""
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Summaries()
        for batch, texts in slices(batches, "text"):
            data, starts, ends = joined_bytes(texts)
            bounds = chunk_bounds(data, starts, ends)
            whole = data.tobytes()
            chunks = [whole[a:b] for at in bounds for a, b in itertools.pairwise(at.tolist())]
            found, i, out = memo.of(chunks), 0, []
            for key, t, at in zip(batch.column("key").to_pylist(), texts, bounds):
                out.append(transform(Text(t or b"", at, found[i : i + len(at) - 1]), key, seed))
                i += len(at) - 1
            n, form, prefix, middle, output = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(n, type=pa.int64()), pa.array(form), pa.array(prefix, type=pa.int64()),
                 pa.array(middle, type=pa.int64()), pa.array(output, type=pa.binary()).view(pa.string())],
                names=["key", "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = T.StructType([rows.schema["key"], *T._parse_datatype_string(
        "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string").fields])
    out = rows.mapInArrow(run, schema)
    return out.withColumnRenamed("key", id_col)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The original text from a transformed one. The marks cannot stand in a text that was cut, nor
    arise where a mark meets it, so splitting at them is exact."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    body = F.substring(output, len(PREFIX) + 1, 0x7FFFFFFF)
    psm, spm = (F.split(body, f"{first}|{MIDDLE}") for first in (SUFFIX, PREFIX))
    return (F.when(form == "psm", F.concat(psm[0], psm[2], psm[1])).when(form == "spm", F.concat(spm[1], spm[2], spm[0])).otherwise(output))


def middle_digest(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows with checksums in place of the output, and of the text rebuilt from it."""
    return rows.select(id_col, "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))


#: DuckDB over ``documents``: all units listed.
FILL_MIDDLE_SQL = r"""
with t as materialized (
  select doc_id, coalesce(text, '') x, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') u, sha256('1:' || doc_id) s from documents),
h as materialized (
  select *, len(u) n, ('0x' || s[1:8])::ubigint h1, ('0x' || s[9:16])::ubigint h2, ('0x' || s[17:24])::ubigint h3, ('0x' || s[25:32])::ubigint h4 from t),
f as materialized (
  select doc_id, x, n, case when x = '' or contains(x, '<P>') or contains(x, '<S>') or contains(x, '<M>') or h3 % 100 >= 90 then 'plain'
    when h4 % 100 < 20 then 'spm' else 'psm' end form,
  array_to_string(u[1 : least(h1 % (n + 1), h2 % (n + 1))::bigint], '') p,
  array_to_string(u[least(h1 % (n + 1), h2 % (n + 1))::bigint + 1 : greatest(h1 % (n + 1), h2 % (n + 1))::bigint], '') m,
  array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1))::bigint + 1 :], '') s from h)
select doc_id, n, form, case when form <> 'plain' then length(p) end prefix_chars, case when form <> 'plain' then length(m) end middle_chars,
  sha256(case form when 'plain' then x when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256,
  sha256(x) restored_sha256 from f
"""
