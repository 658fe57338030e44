"""Fill-in-middle transformation on piece tables.

A document is never copied while it is worked on. It is a list of descriptors (buffer, start, end) over two immutable
buffers, the text's UTF-8 bytes and the sentinels. Cutting splits the descriptor at a position, an arrangement permutes
descriptors and puts sentinel descriptors between them, the inverse permutation undoes it, and hashes read the
descriptors one after another. Only the output column itself is a copy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tabsmith.llm.common import packed, q, read, text_or_empty, unpacked

# fixed values: sentinels, and the order of (prefix, middle, suffix) in each form
SENTINELS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
FORMS = {"psm": (("P", 0), ("S", 2), ("M", 1)), "spm": (("S", 2), ("P", 0), ("M", 1))}

_SENTINEL_BUFFER = b"".join(SENTINELS.values())
_SENTINEL_AT = {name: (3 * i, 3 * i + 3) for i, name in enumerate(SENTINELS)}
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Piece(NamedTuple):
    """A descriptor: bytes ``start`` to ``end`` of buffer 0 (the text) or 1 (the sentinels)."""

    buffer: int
    start: int
    end: int


class PieceTable:
    """Descriptors over a text buffer and the sentinel buffer; the buffers are never changed."""

    def __init__(self, text: bytes, pieces: list[Piece] | None = None):
        self.buffers = (memoryview(text), memoryview(_SENTINEL_BUFFER))
        self.pieces = [Piece(0, 0, len(text))] if pieces is None else pieces

    def cut(self, *positions: int) -> PieceTable:
        """Split so that a descriptor ends at each position (of the table's own sequence); equal ones give empty pieces."""
        out, at, todo = [], 0, sorted(positions)
        for b, start, end in self.pieces:
            while todo and at <= todo[0] <= at + end - start:
                mid = start + todo.pop(0) - at
                out.append(Piece(b, start, mid))
                at, start = at + mid - start, mid
            out.append(Piece(b, start, end))
            at += end - start
        return self._with(out)

    def arrange(self, form: str) -> PieceTable:
        """Three pieces (prefix, middle, suffix) → the form's order, each behind its sentinel."""
        out = []
        for name, which in FORMS[form]:
            out += [Piece(1, *_SENTINEL_AT[name]), self.pieces[which]]
        return self._with(out)

    def restore(self, form: str) -> PieceTable:
        """Pieces as ``arrange`` leaves them → prefix, middle and suffix in the text's order."""
        back = sorted(range(3), key=lambda i: FORMS[form][i][1])
        return self._with([self.pieces[2 * i + 1] for i in back])

    def _with(self, pieces: list[Piece]) -> PieceTable:
        table = PieceTable.__new__(PieceTable)
        table.buffers, table.pieces = self.buffers, pieces
        return table

    def views(self) -> Iterator[memoryview]:
        for b, start, end in self.pieces:
            yield self.buffers[b][start:end]

    def sha256(self) -> str:
        h = hashlib.sha256()
        for v in self.views():
            h.update(v)
        return h.hexdigest()

    def tobytes(self) -> bytes:
        return b"".join(self.views())


def parse_output(output: bytes, form: str) -> PieceTable:
    """A transformed text as the table that ``arrange`` gave, but over the output's own bytes.

    No sentinel stands inside the pieces, and none can arise where a piece meets a sentinel (a sentinel begins with its
    only ``<`` and ends with its only ``>``), so the first match of each in turn is the true one.
    """
    cuts, at = [], 0
    for name, _ in FORMS[form]:
        at = output.index(SENTINELS[name], at)
        cuts += [at, at + 3]
        at += 3
    return PieceTable(output).cut(*cuts[1:])  # the first sentinel opens the text: its begin needs no cut


def restore_bytes(output: bytes, form: str) -> PieceTable:
    return PieceTable(output) if form == "plain" else parse_output(output, form).restore(form)


def unit_ends(data: np.ndarray) -> np.ndarray:
    """End bytes of the units: each run without white space with the space before it, and white space left at the end."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    space = _SPACE[data]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(data))  # the last run's end, or white space with no run after it


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four keyed 32-bit draws: the first 8-digit groups of the SHA-256 of ``seed:doc_id`` (null id: nothing after the colon)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4)]


def code_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def transform(text: bytes, doc_id: int | None, seed: int, rate: int, spm_rate: int) -> tuple[PieceTable, str, int, int | None, int | None]:
    """(table, form, units, prefix and middle code points) of one whole text."""
    data = np.frombuffer(text, dtype=np.uint8)
    ends = unit_ends(data)
    n = len(ends)
    h = draws(seed, doc_id)
    table = PieceTable(text)
    if not text or any(s in text for s in SENTINELS.values()) or h[2] % 100 >= rate:
        return table, "plain", n, None, None
    a, b = (int(ends[u - 1]) if u else 0 for u in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    form = "spm" if h[3] % 100 < spm_rate else "psm"
    return table.cut(a, b).arrange(form), form, n, code_points(data[:a]), code_points(data[a:b])


_OUT = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                  ("output", pa.string()), ("output_sha256", pa.string())])


def _passed_on(batch: pa.RecordBatch) -> tuple[list, list]:
    keep = [i for i, name in enumerate(batch.schema.names) if name not in ("_text", "_id")]
    return [batch.column(i) for i in keep], [batch.schema.field(i) for i in keep]


def _slices(batches, rows: int = 256):
    """Batches of few rows: outputs are as long as the texts, and a batch of them is held at once."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _transform_batches(seed: int, rate: int, spm_rate: int):
    def run(batches):
        for batch in _slices(batches):
            columns, fields = _passed_on(batch)
            texts = batch.column(batch.schema.names.index("_text")).cast(pa.binary())
            ids = batch.column(batch.schema.names.index("_id")).to_pylist()
            rows = []
            for text, doc_id in zip(texts, ids):
                table, form, n, prefix, middle = transform(text.as_py(), doc_id, seed, rate, spm_rate)
                rows.append((n, form, prefix, middle, table.tobytes(), table.sha256()))
            made = list(zip(*rows)) if rows else [[]] * len(_OUT)
            arrays = [pa.array(list(made[i]), pa.binary()).cast(pa.string()) if f.name == "output" else pa.array(list(made[i]), f.type)
                      for i, f in enumerate(_OUT)]
            yield pa.RecordBatch.from_arrays(columns + arrays, schema=pa.schema(fields + list(_OUT)))
    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50,
                   spm_rate: int = 80) -> DataFrame:
    """Every row of ``docs`` with ``n`` units, ``form``, ``prefix_chars``, ``middle_chars``, ``output`` and ``output_sha256``.

    A unit is a run without white space with the white space before it, or white space at the text's end. Of 100 rows,
    ``rate`` are transformed on average and ``spm_rate`` % of these take form spm, else psm, drawn by ``seed`` and id
    alone, so rows that repeat an id and a text give equal results in any partitioning. Plain (null lengths): empty
    texts, texts that already hold a sentinel, and rows not drawn. A null text counts as empty, a null id draws by the
    seed alone. Texts are worked on whole, however long: two short arrays beside the text and its output. An empty table
    gives an empty result; an input column with the name of an output gives way to it.
    """
    rows = docs.select(packed(docs).alias("_row"), F.col(q(id_col)).cast("long").alias("_id"), text_or_empty(text_col).alias("_text"))
    schema = StructType([rows.schema["_row"], *[StructField(n, StringType() if pa.types.is_string(t) else LongType())
                                                for n, t in zip(_OUT.names, _OUT.types)]])
    made = rows.mapInArrow(_transform_batches(seed, rate, spm_rate), schema)
    return unpacked(made, docs.columns, _OUT.names)


def restore_text(output: str, form: str):
    """Column (text, sha256) of the text that a transformed ``output`` column and its ``form`` give back; nulls read as empty and plain."""
    @F.pandas_udf("struct<text: string, sha256: string>")
    def restored(outputs: pd.Series, forms: pd.Series) -> pd.DataFrame:
        tables = [restore_bytes((o or "").encode("utf-8", "surrogatepass"), f or "plain") for o, f in zip(outputs, forms)]
        return pd.DataFrame({"text": [t.tobytes().decode("utf-8", "surrogatepass") for t in tables],
                             "sha256": [t.sha256() for t in tables]})

    return restored(F.col(q(output)), F.col(q(form)))


def op12_fim_piece_table(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_in_middle(docs).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256")
    back = made.withColumn("_back", restore_text("output", "form"))
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                       F.col("_back.sha256").alias("restored_sha256"))


OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
d AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
