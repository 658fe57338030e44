"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search goes over the text once. Each boundary between characters keeps one best way to reach it: the last piece and
the boundary before it. A new boundary can only be reached from the boundaries at most one piece length back, so that
window is all that the search looks at; ids are committed as soon as the paths of all boundaries in the window have run
together in one boundary.

Two rules say which way is best. ``unigram``: the highest sum of piece scores, longer last pieces first on a tie.
``bpe``: a piece may follow another only if merging, best score and leftmost first, leaves exactly these two pieces of
their joined text. Every prefix of a text has one such path, and it is the result of the merges on the whole prefix, so
the ids are those of the sentencepiece library.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.llm.common import packed, q, read, text_or_empty, unpacked

SPACE = "▁"  # stands for a space in pieces
LITERAL = "\ud800"  # stands for that character itself in a text; a lone surrogate is in no valid text
UNKNOWN_PENALTY = 10.0
BREAK = "\n"
START = (1 << 32) - 1  # number of what stands before the first piece
CHARACTER = 1 << 22  # first number of characters without a piece


class Codec:
    """Vocabulary of a model file and the search over it; one per Python worker."""

    KEPT = 250_000  # words in each of two generations of the memo (about 0.2 KB a word)
    LONG = 64  # longer words are searched each time
    PAIRS = 400_000  # remembered answers of ``follows``

    def __init__(self, path: str, rule: str = "bpe") -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if rule not in ("bpe", "unigram"):
            raise ValueError(f"unknown rule {rule}")
        self.rule = rule
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            self.scores.append(model.get_score(i))
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.ids[piece] = i
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.ids), default=1)
        self.pieces = {i: p for p, i in self.ids.items()}
        # every ending of a piece → the id of the piece it is itself, or -1
        self.tails = {p[i:]: -1 for p in self.ids for i in range(len(p))} | self.ids
        self.lowest = min(self.scores, default=0.0) - UNKNOWN_PENALTY
        # A word can be searched alone if no piece goes on with a space after another character, or holds a line break.
        self.by_word = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids)
        self.pairs: dict[int, bool] = {}
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merges(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Pieces of a short text by merging neighbours, the best score first, then the leftmost; and the last merge."""
        parts, pair = list(text), None
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                n = self.ids.get(parts[i] + parts[i + 1])
                if n is not None and (best is None or self.scores[n] > best):
                    best, at = self.scores[n], i
            if best is None:
                break
            pair = (parts[at], parts[at + 1])
            parts[at:at + 2] = [pair[0] + pair[1]]
        return parts, pair

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge made this one; None for a single character; ("", "") if merges never make it."""
        if piece not in self.halves:
            parts, pair = self.merges(piece)
            self.halves[piece] = (pair if len(parts) == 1 else ("", "")) if len(piece) > 1 else None
        return self.halves[piece]

    def follows(self, left: str, right: str) -> bool:
        """May ``right`` stand after ``left`` (empty: at the start), that is, do the merges of both leave their border?

        Go back in time: undo the later of the two pieces' last merges, keeping the parts at the border. If the parts at
        the border could merge before the merge that was undone (or as one with it, but further left), they would have.
        """
        if self.split(right) == ("", "") or left and self.split(left) == ("", ""):
            return False
        if not left:
            return True
        scores, ids, low = self.scores, self.ids, -float("inf")
        bar, ties = low, False  # score of the merge undone last, and whether a tie goes to the border
        while True:
            n = ids.get(left + right)
            if n is not None and (scores[n] > bar or ties and scores[n] == bar):
                return False
            a, b = self.split(left), self.split(right)
            if a is None and b is None:
                return True
            # the later merge has the lower score; of equal ones the right piece's is the later
            if b is None or a is not None and scores[ids[left]] < scores[ids[right]]:
                bar, ties, left = scores[ids[left]], False, a[1]
            else:
                bar, ties, right = scores[ids[right]], True, b[0]

    def _piece(self, n: int) -> str:
        return "" if n == START else self.pieces[n] if n < CHARACTER else chr(n - CHARACTER)

    def search(self, chunks: Iterable[str]) -> Iterator[int]:
        """Numbers of the pieces of the concatenated chunks, each as soon as it is certain.

        A piece's number is its id, that of a character without a piece CHARACTER plus its code point.
        """
        text = ""  # what is not committed yet
        before, tail, best = [0], [START], [0.0]  # per boundary of it: where its last piece begins, which it is, the score
        for chunk in chunks:
            for at in range(0, len(chunk), self.longest):
                text += chunk[at:at + self.longest]
                self._extend(text, before, tail, best)
                if len(text) >= 4 * self.longest:
                    cut = self._meeting(before, len(text))
                    if cut:
                        yield from self._path(before, tail, cut)
                        text = text[cut:]
                        before = [max(0, b - cut) for b in before[cut:]]
                        tail, best = tail[cut:], best[cut:]
        yield from self._path(before, tail, len(text))

    def _extend(self, text: str, before: list[int], tail: list[int], best: list[float]) -> None:
        """Best ways to the boundaries that ``before`` does not have yet."""
        known, pairs, bpe = self.tails.get, self.pairs, self.rule == "bpe"
        for end in range(len(before), len(text) + 1):
            at = end - 1
            c = text[at]
            n = known(c, -1)
            starts, numbers = [at], [n if n >= 0 else CHARACTER + ord(c)]  # pieces that end here, the shortest first
            for start in range(end - 2, -1, -1):
                n = known(text[start:end])
                if n is None:
                    break
                if n >= 0:
                    starts.append(start)
                    numbers.append(n)
            j = 0
            if bpe:
                for j in range(len(starts) - 1, -1, -1):  # longest first
                    key = tail[starts[j]] << 32 | numbers[j]
                    ok = pairs.get(key)
                    if ok is None:
                        if len(pairs) >= self.PAIRS:
                            pairs.clear()
                        ok = pairs[key] = self.follows(self._piece(tail[starts[j]]), self._piece(numbers[j]))
                    if ok:
                        break
            else:
                top = -float("inf")
                for i in range(len(starts) - 1, -1, -1):
                    score = best[starts[i]] + (self.scores[numbers[i]] if numbers[i] < CHARACTER else self.lowest)
                    if score > top:
                        top, j = score, i
                best.append(top)
            before.append(starts[j])
            tail.append(numbers[j])

    def _meeting(self, before: list[int], end: int) -> int:
        """The boundary through which the paths of all boundaries in the window go (0: none but the start)."""
        alive = set(range(max(0, end - self.longest + 1), end + 1))
        while len(alive) > 1:
            far = max(alive)
            alive.discard(far)
            alive.add(before[far])
        return alive.pop()

    @staticmethod
    def _path(before: list[int], tail: list[int], end: int) -> Iterator[int]:
        numbers = []
        while end > 0:
            numbers.append(tail[end])
            end = before[end]
        return reversed(numbers)

    def _numbers(self, found: Iterable[int]) -> bytes:
        out: list[int] = []
        for n in found:
            if n < CHARACTER:
                out.append(n)
            else:
                c = chr(n - CHARACTER)
                out.extend(self.byte_ids[b] for b in (SPACE if c == LITERAL else c).encode("utf-8", "surrogatepass"))
        return np.array(out, "<i4").tobytes()

    def _word(self, key: str) -> bytes:
        if key[0] == BREAK:
            return self._numbers([CHARACTER + ord(BREAK)]) + self._numbers(self.search([key[1:]]))
        text = SPACE + key
        if len(text) >= 4 * self.longest:
            return self._numbers(self.search([text]))
        before, tail = [0], [START]  # too short for anything to be committed on the way
        self._extend(text, before, tail, [0.0])
        return self._numbers(self._path(before, tail, len(text)))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; a space goes before it, spaces are SPACE, and an empty text has none."""
        if not text:
            return np.zeros(0, "<i4")
        if SPACE in text:
            text = text.replace(SPACE, LITERAL)
        if not self.by_word or text[0] in " \n" or "  " in text or "\n " in text or " \n" in text or text[-1] == " ":
            pieces = (text[i:i + 4096].replace(" ", SPACE) for i in range(0, len(text), 4096))
            return np.frombuffer(self._numbers(self.search(p for part in ([SPACE], pieces) for p in part)), "<i4")
        # a word after a space as it is, after a line break with the break
        keys = text.replace("\n", " \n").split(" ")
        get = self.young.get
        got = list(map(get, keys))
        if None in got:
            for i, v in enumerate(got):
                if v is None:
                    k = keys[i]
                    v = self.young.get(k) or self.old.get(k) or self._word(k)
                    if len(k) <= self.LONG:
                        self.young[k] = v
                    got[i] = v
            if len(self.young) > self.KEPT:
                self.old, self.young = self.young, {}
        return np.frombuffer(b"".join(got), "<i4")

    def rest(self) -> None:
        """Let go of the remembered words; ids do not depend on them."""
        self.young, self.old = {}, {}

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; the space before it goes again. Control ids have no text."""
        data = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return data.removeprefix(b" ").decode("utf-8", "replace")


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, rule: str) -> Codec:
    """This Python worker's codec."""
    if (path, rule) not in _codecs:
        _codecs[path, rule] = Codec(path, rule)
    return _codecs[path, rule]


ROWS = 512  # rows whose ids are held at once


def _encoder(path: str, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(path, rule)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    texts = part.column("_text").to_pylist()
                    ids = [model.encode(t) for t in texts]
                    same = [model.decode(x) == t for x, t in zip(ids, texts)]
                    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                    lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), np.concatenate(ids))
                    yield pa.RecordBatch.from_arrays([part.column("_row"), lists, pa.array(sizes), pa.array(same, pa.bool_())],
                                                     names=["_row", "ids", "n_tokens", "round_trip"])
        finally:
            model.rest()  # the worker lives on and may serve other stages, whose memory this is

    return run


def decode_column(path: str, rule: str = "bpe"):
    @F.pandas_udf("string")
    def decode(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in ids:
            yield pd.Series([None if x is None else codec(path, rule).decode(np.asarray(x)) for x in s], dtype=object)

    return decode


def round_trip_column(path: str, rule: str = "bpe"):
    """Digest of encoding a text and decoding its ids, without moving the ids out of the worker."""
    @F.pandas_udf("n_tokens long, ids_crc32 long, round_trip boolean")
    def check(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            rows = []
            for t in s:
                ids = codec(path, rule).encode(t)
                rows.append((len(ids), zlib.crc32(ids.tobytes()), codec(path, rule).decode(ids) == t))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_crc32", "round_trip"])

    return check


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, path: str | None = None, text_col: str = "text", rule: str = "bpe",
                     keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with ``ids``, ``n_tokens`` and ``round_trip`` (decoding the ids gives the text again).

    The whole text is encoded. Null and empty texts have no ids and count as a round trip to the empty text. Repeated
    rows appear once each; an input column named like an output is replaced. ``keep`` names the columns that go along
    (all by default). One pass through one Python worker per task, which holds the ids of ROWS rows at a time.
    """
    columns = docs.columns if keep is None else keep
    rows = docs.select(packed(docs.select(*[q(c) for c in columns])).alias("_row"), text_or_empty(text_col).alias("_text"))
    schema = T.StructType([rows.schema["_row"], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())])
    return unpacked(rows.mapInArrow(_encoder(path or model_path(), rule), schema), columns, ["ids", "n_tokens", "round_trip"])


def op5_sentencepiece_viterbi(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = docs.select("doc_id", round_trip_column(model_path())(text_or_empty("text")).alias("r"))
    return out.select("doc_id", "r.*")
