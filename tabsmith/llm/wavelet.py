"""Token-id shards as wavelet matrices: one compressed file that answers access, rank, count and select.

File layout (little-endian):
  b"WVMX0001" | bit-plane blocks, each compressed | document index, compressed | rank directory | JSON footer |
  u32 footer length | b"WVMX0001"
Plane l holds bit l (from the highest) of every id, in the order that the planes above have sorted the ids: zeros first,
both halves in their old order. Planes are cut into blocks of BLOCK bits; the rank directory has the ones before each
block and the block's place in the file, so a query decompresses only the blocks that it touches.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import checkpointed, open_fs, q, read, scratch_dir, text_or_empty

MAGIC = b"WVMX0001"
BLOCK = 1 << 16  # bits in a compressed block (8 KB before compression)


def _compress(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(data)


def _decompress(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def write_shard(out, ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> int:
    """Write one shard to a binary stream; returns its bytes."""
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    at = out.write(MAGIC)
    ones_before, places, zeros = [], [], []
    work = ids
    for level in range(levels - 1, -1, -1):
        mask = (work & work.dtype.type(1 << level)) != 0
        packed = np.packbits(mask, bitorder="little").tobytes()
        count, where = 0, []
        for b in range(0, len(mask), BLOCK):
            data = _compress(packed[b // 8:(b + BLOCK) // 8])
            out.write(data)
            where.append(at)
            at += len(data)
            ones_before.append(count)
            count += int(np.count_nonzero(mask[b:b + BLOCK]))
        ones_before.append(count)
        places.extend([*where, at])
        zeros.append(len(mask) - count)
        work = np.concatenate((np.compress(~mask, work), np.compress(mask, work)))
    index = struct.pack("<Q", len(doc_ids)) + np.array([d is None for d in doc_ids], bool).tobytes() + np.array(
        [d or 0 for d in doc_ids], "<i8").tobytes() + np.array(lengths, "<i8").tobytes()
    directory = np.array(ones_before, "<i8").tobytes() + np.array(places, "<i8").tobytes()
    parts = [(at, _compress(index)), None]
    parts[1] = (at + len(parts[0][1]), _compress(directory))
    footer = json.dumps({"n": len(ids), "levels": levels, "block": BLOCK, "zeros": zeros, "docs": len(doc_ids),
                         "index": [parts[0][0], len(parts[0][1])], "directory": [parts[1][0], len(parts[1][1])]}).encode()
    tail = parts[0][1] + parts[1][1] + footer + struct.pack("<I", len(footer)) + MAGIC
    out.write(tail)
    return at + len(tail)


class WaveletShard:
    """A shard opened from a seekable binary stream; reads what it needs and keeps a few blocks."""

    def __init__(self, source, cached_blocks: int = 256) -> None:
        self.source = source
        source.seek(0, 2)
        size = source.tell()
        tail = self._read(size - 12, 12)
        if tail[4:] != MAGIC:
            raise ValueError("not a complete shard")
        length = struct.unpack("<I", tail[:4])[0]
        meta = json.loads(self._read(size - 12 - length, length))
        self.n, self.levels, self.zeros, self.block = meta["n"], meta["levels"], meta["zeros"], meta["block"]
        self._index = meta["index"]
        numbers = np.frombuffer(_decompress(self._read(*meta["directory"])), "<i8")
        each = -(-self.n // self.block) + 1
        self.ones = numbers[:each * self.levels].reshape(self.levels, each)
        self.places = numbers[each * self.levels:].reshape(self.levels, each)
        self._bits = lru_cache(cached_blocks)(self._load)

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _load(self, level: int, block: int) -> np.ndarray:
        start, end = int(self.places[level, block]), int(self.places[level, block + 1])
        raw = np.frombuffer(_decompress(self._read(start, end - start)), np.uint8)
        return np.unpackbits(raw, count=min(self.block, self.n - block * self.block), bitorder="little")

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        raw = _decompress(self._read(*self._index))
        n = struct.unpack("<Q", raw[:8])[0]
        none = np.frombuffer(raw, bool, n, 8)
        ids = np.frombuffer(raw, "<i8", n, 8 + n)
        return [None if x else int(i) for x, i in zip(none, ids)], np.frombuffer(raw, "<i8", n, 8 + 9 * n)

    def _bit(self, level: int, i: int) -> int:
        return int(self._bits(level, i // self.block)[i % self.block])

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        b, r = divmod(i, self.block)
        return int(self.ones[level, b]) + (int(self._bits(level, b)[:r].sum(dtype=np.int64)) if r else 0)

    def access(self, i: int) -> int:
        """Token id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            bit, ones = self._bit(level, i), self._rank1(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, token: int, a: int, b: int) -> tuple[int, int]:
        if token < 0 or token >> self.levels:
            return 0, 0
        for level in range(self.levels):
            ra, rb = self._rank1(level, a), self._rank1(level, b)
            if token >> (self.levels - 1 - level) & 1:
                a, b = self.zeros[level] + ra, self.zeros[level] + rb
            else:
                a, b = a - ra, b - rb
        return a, b

    def count(self, token: int, a: int = 0, b: int | None = None) -> int:
        """How often a token occurs in positions a to b (without b)."""
        lo, hi = self._range(token, max(0, a), min(self.n, self.n if b is None else b))
        return max(0, hi - lo)

    def rank(self, token: int, i: int) -> int:
        """Occurrences of a token before position i."""
        return self.count(token, 0, i)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit of a plane."""
        before = self.ones[level] if bit else np.minimum(np.arange(self.ones.shape[1]) * self.block, self.n) - self.ones[level]
        b = int(np.searchsorted(before, k, side="right")) - 1
        hits = np.flatnonzero(self._bits(level, b) == bit)
        return b * self.block + int(hits[k - int(before[b])])

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - level) & 1
            i = self._select_bit(level, bit, i - self.zeros[level] if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids in order, plane by plane from the lowest."""
        work = np.zeros(self.n, dtype=np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            blocks = [self._load(level, b) for b in range(-(-self.n // self.block))]
            mask = (np.concatenate(blocks) if blocks else np.zeros(0, np.uint8)).view(bool)
            out = np.empty_like(work)
            out[~mask], out[mask] = work[:self.zeros[level]], work[self.zeros[level]:]
            work = out | (mask.astype(out.dtype) << out.dtype.type(self.levels - 1 - level))
        return work


def _gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Stretches of a pool one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(pool)) < 1 << 31 else np.int64
    return pool[np.repeat((starts - (ends - lengths)).astype(kind), lengths) + np.arange(total, dtype=kind)]


class Encoder:
    """Byte-level BPE of the tokenizers library, with the ids of recent words kept.

    Where white space comes as single spaces and line breaks inside a text, each between two other characters, the
    tokenizer always cuts before it: before a space (which belongs to the word after it) and around a line break. So
    such a text's words can be encoded one by one and their ids joined: a batch is cut into words, only its distinct
    words are looked up or encoded, and the ids of all words are gathered. All other texts go to the tokenizer whole.
    A word of letters after a space is one piece to the pre-tokenizer, so such words go to a copy of the tokenizer that
    only cuts at spaces and spares the regular expression; each word's first token is the one that begins with the space.
    Marks after such a word are a piece of their own, so that "word," and "word." need one look at "word".

    With ``match_added`` the strings of the tokenizer's added tokens (such as <|endoftext|>) get those tokens' ids, as the
    library does unless told otherwise; texts that hold one go to the tokenizer whole. Without it they are ordinary text.
    """

    KEPT = 400_000  # words (some 40 bytes a word)
    TOGETHER = 100  # words that the library gets as one text
    CALL = 8  # texts of a call: the library's own results are large
    # letters in every version of Unicode: Latin, its supplement and extension A
    LETTERS = "^[A-Za-z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{17f}]+$"
    LONG = 64  # longer words are not kept
    # two white-space characters in a row, white space at an end, any white space but space and line break, or a zero
    ODD = ("[ \\n][ \\n]|^[ \\n]|[ \\n]$|[\\x00\\t\\x0b-\\x0d\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
           "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]|^$")

    def __init__(self, path: str, end_id: int = 0, match_added: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.odd = self.ODD
        if match_added:
            added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
            # words are learnt with line breaks between them, so a token with one leaves no text to cut
            self.odd = "" if any("\n" in t for t in added) else "|".join([self.ODD, *map(re.escape, added)])
        else:
            self.tokenizer.encode_special_tokens = True
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # known words are kept here, so its own cache would only cost time
        self.kind = np.dtype("<u2" if max(self.tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else "<u4")
        self.end = np.array([end_id], self.kind)
        self.newline = int(self.whole(["\n"])[0][0])
        self.plain = self._without_regex()
        self._forget()

    def _without_regex(self):
        """The tokenizer with no regular expression before the merges, or None if it is not a plain byte-level one.

        Its added tokens must be special ones, which are ordinary text here or leave a text whole."""
        from tokenizers import Tokenizer, pre_tokenizers

        before = self.tokenizer.pre_tokenizer
        rule = json.loads(before.__getstate__()) if before is not None else {}
        added = self.tokenizer.get_added_tokens_decoder().values()
        if (not all(t.special for t in added) or self.tokenizer.normalizer is not None or rule.get("type") != "ByteLevel" or not rule.get("use_regex")
                or rule.get("add_prefix_space") or len(self.whole(["\n"])[0]) != 1):
            return None
        plain = Tokenizer.from_str(self.tokenizer.to_str())
        plain.encode_special_tokens = self.tokenizer.encode_special_tokens
        if hasattr(plain.model, "_resize_cache"):
            plain.model._resize_cache(0)
        plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "merged_with_next"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        tokens = plain.get_vocab()
        self.begins = np.zeros(max(tokens.values()) + 1, bool)
        self.begins[[i for t, i in tokens.items() if t.startswith("\u0120")]] = True  # a space as the vocabulary has it
        return plain

    def _forget(self) -> None:
        # words with their places in the pool; the first character of a word tells what stands before it, see encode
        self.words, self.pool = pa.array([], pa.string()), np.zeros(0, self.kind)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def whole(self, texts: list[str], tokenizer=None) -> list[np.ndarray]:
        """Ids of whole texts from the library."""
        encode = (tokenizer or self.tokenizer).encode_batch_fast
        return [np.array(e.ids, self.kind) for at in range(0, len(texts), self.CALL) for e in encode(texts[at:at + self.CALL], add_special_tokens=False)]

    def _joined(self, words: pa.Array, by: str) -> list[str]:
        cuts = np.append(np.arange(0, len(words), self.TOGETHER), len(words)).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words), by).to_pylist()

    def _learn(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, starts, lengths) of unknown words, many in one text."""
        starts, lengths = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        letters = np.zeros(len(keys), bool)
        if self.plain is not None:
            letters = pc.match_substring_regex(keys, self.LETTERS).to_numpy(zero_copy_only=False)
        pool = np.zeros(0, self.kind)
        if letters.any():
            texts = [" " + t for t in self._joined(keys.filter(pa.array(letters)), " ")]
            pool = np.concatenate(self.whole(texts, self.plain))
            starts[letters] = at = np.flatnonzero(self.begins[pool])
            lengths[letters] = np.diff(at, append=len(pool))
        if not letters.all():  # line breaks between words cut exactly there
            rest = keys.filter(pa.array(~letters))
            line = pc.starts_with(rest, "\n")
            first = pc.or_(line, pc.starts_with(rest, "\0"))
            texts = pc.if_else(first, pc.utf8_slice_codeunits(rest, 1), pc.binary_join_element_wise(pa.scalar(" "), rest, pa.scalar("")))
            nl = np.array([self.newline], self.kind)
            some = np.concatenate([nl, *(x for ids in self.whole(self._joined(texts, "\n")) for x in (ids, nl))])
            cuts, after = np.flatnonzero(some == self.newline), line.to_numpy(zero_copy_only=False)
            starts[~letters] = len(pool) + cuts[:-1] + 1 - after  # a word after a line break has the one before it
            lengths[~letters] = np.diff(cuts) - 1 + after
            pool = np.concatenate((pool, some))
        return pool, starts, lengths

    def _places(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, starts, lengths) of distinct words."""
        known, starts, lengths = self._known(words)
        if known.all():
            return self.pool, starts, lengths
        new = words.filter(pa.array(~known))
        stems, tailed = self._stems(new)
        asked = pa.concat_arrays([new.filter(pa.array(~tailed)), stems]).dictionary_encode()
        have, s, n = self._known(asked.dictionary)
        base, size = asked.dictionary.filter(pa.array(~have)), len(self.pool)
        learnt, s[~have], n[~have] = self._learn(base)
        s[~have] += size
        pool, which, k = np.concatenate((self.pool, learnt)), asked.indices.to_numpy(), len(new) - len(stems)
        own, each = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        own[~tailed], each[~tailed] = s[which[:k]], n[which[:k]]
        if len(stems):  # their ids are the stem's and those of the marks after it
            tails = pc.replace_substring_regex(new.filter(pa.array(tailed)), self.LETTERS[:-1], "").dictionary_encode()
            marks = self.whole(tails.dictionary.to_pylist())
            long = np.array([len(x) for x in marks])
            at, tail = len(pool) + np.cumsum(long) - long, tails.indices.to_numpy()
            both = np.stack((s[which[k:]], at[tail]), axis=1).ravel(), np.stack((n[which[k:]], long[tail]), axis=1).ravel()
            each[tailed] = n[which[k:]] + long[tail]
            made = _gathered(np.concatenate((pool, *marks)), *both)
            own[tailed] = len(pool) + np.cumsum(each[tailed]) - each[tailed]
            pool = np.concatenate((pool, made))
        starts[~known], lengths[~known] = own, each
        self._keep(pa.concat_arrays([base, new.filter(pa.array(tailed))]), pool[size:],
                   np.concatenate((s[~have], own[tailed])) - size, np.concatenate((n[~have], each[tailed])))
        return pool, starts, lengths

    def _known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are kept, and the places of those."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()
        known, starts, lengths = at >= 0, np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[known], lengths[known] = self.starts[at[known]], self.lengths[at[known]]
        return known, starts, lengths

    def _stems(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(letters, which words) of words that are letters and then ASCII marks: two pieces to the pre-tokenizer."""
        stems = pc.utf8_rtrim(words, characters=string.punctuation)
        tailed = pc.less(pc.binary_length(stems), pc.binary_length(words))
        if self.plain is None:
            return stems.slice(0, 0), np.zeros(len(words), bool)
        tailed = pc.and_(tailed, pc.match_substring_regex(stems, self.LETTERS))
        return stems.filter(tailed), tailed.to_numpy(zero_copy_only=False)

    def _keep(self, new: pa.Array, learnt: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        short = pc.less_equal(pc.utf8_length(new), self.LONG)
        mask = short.to_numpy(zero_copy_only=False)
        if len(self.words) + len(new) > self.KEPT or len(self.pool) + len(learnt) > 16 * self.KEPT:
            self._forget()
        if len(learnt) <= 16 * self.KEPT:
            self.words = pa.concat_arrays([self.words, new.filter(short)])
            self.starts = np.concatenate((self.starts, starts[mask] + len(self.pool)))
            self.lengths = np.concatenate((self.lengths, lengths[mask]))
            self.pool = np.concatenate((self.pool, learnt))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, each with the end id; how many each has)."""
        odd = pc.match_substring_regex(texts, self.odd)
        # words: after a space as they are, after a line break with the break, the first of a text with a zero
        keys = pc.binary_join_element_wise(pa.scalar("\0"), pc.replace_substring(texts, "\n", " \n"), pa.scalar(""))
        marked = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(marked):  # a text that goes to the tokenizer whole counts as one word of its own
            names = pa.array([f"\0\0{i}" for i in range(len(texts))])
            keys = pc.if_else(odd, names, keys)
        words = pc.split_pattern(keys, " ")
        coded = words.values.dictionary_encode()
        distinct = coded.dictionary
        special = np.zeros(len(distinct), bool)
        if len(marked):
            special = pc.starts_with(distinct, "\0\0").to_numpy(zero_copy_only=False)
        starts, lengths = np.zeros(len(distinct) + 1, np.int64), np.zeros(len(distinct) + 1, np.int64)
        usual = np.flatnonzero(~special)
        pool, starts[usual], lengths[usual] = self._places(distinct.filter(pa.array(~special)) if len(marked) else distinct)
        rows = [int(k[2:]) for k in distinct.filter(pa.array(special)).to_pylist()]
        extra = [*(self.whole(texts.take(pa.array(rows)).to_pylist()) if rows else []), self.end]
        own = np.append(np.flatnonzero(special), len(distinct))  # the last one is the end id
        lengths[own] = [len(x) for x in extra]
        starts[own] = len(pool) + np.cumsum(lengths[own]) - lengths[own]
        pool = np.concatenate((pool, *extra))
        offsets = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
        codes = np.insert(coded.indices.to_numpy(), offsets[1:], len(distinct))
        each = lengths[codes]
        ends = np.cumsum(each)
        ids = _gathered(pool, starts[codes], each)
        last = ends[offsets[1:] + np.arange(len(texts))]  # each text's end id closes it
        return ids, np.diff(last, prepend=0)


_encoders: dict[tuple[str, int, bool], Encoder] = {}


def encoder(path: str, end_id: int, match_added: bool) -> Encoder:
    """This Python worker's encoder."""
    key = (path, end_id, match_added)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long, bytes long"
TEXT_BYTES = 4 << 20  # texts that are encoded together


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) slices of some MB; a longer text makes a slice of its own."""
    texts, numbers = batch.column("text"), batch.column("id")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT_BYTES, side="right")))
        yield numbers.slice(at, upto - at), texts.slice(at, upto - at)
        at = upto


def _writer(folder: str, tokenizer: str, end_id: int, shard_tokens: int, match_added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        part, seq = TaskContext.get().partitionId(), 0
        ids, docs, lengths, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, ids, docs, lengths, held
            # a name of its own for every attempt: only the files that the manifest lists count
            path = f"{base}/part-{part:05d}-{seq:05d}-{uuid.uuid4().hex}.wvm"
            with fs.open_output_stream(path) as out:
                size = write_shard(out, np.concatenate(ids), docs, np.concatenate(lengths))
            row = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [path],
                "n_docs": [len(docs)], "n_tokens": [held], "bytes": [size]})
            seq, ids, docs, lengths, held = seq + 1, [], [], [], 0
            return row

        for batch in batches:
            for numbers, texts in _pieces(batch):
                got, each = encoder(tokenizer, end_id, match_added).encode(texts)
                ends = np.cumsum(each)
                numbers, at = numbers.to_pylist(), 0
                while at < len(each):  # shards end with the document that fills them
                    done = int(ends[at - 1]) if at else 0
                    upto = min(len(each), int(np.searchsorted(ends, done + shard_tokens - held)) + 1)
                    ids.append(got[done:int(ends[upto - 1])])
                    docs += numbers[at:upto]
                    lengths.append(each[at:upto])
                    held += int(ends[upto - 1]) - done
                    at = upto
                    if held >= shard_tokens:
                        yield flush()
        if docs:
            yield flush()

    return run


def write_shards(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
                 shard_tokens: int = 1 << 22, folder: str | None = None, match_added: bool = False) -> DataFrame:
    """Encode and write all documents in ascending id order; returns the manifest (part, seq, path, ...) with ``start``.

    Shards follow each other by (part, seq) and ``start`` is the number of ids before a shard. Null texts are empty; a
    null id comes last; rows with the same id are ordered by a hash of their text; repeated rows are all written. An
    empty table gives no shard. Files are written under names of their own, and only those of finished tasks are in
    the manifest, so a lost executor leaves at most files that nothing refers to. ``match_added`` is that of Encoder.
    """
    folder = folder or scratch_dir(docs.sparkSession, "tokens")
    rows = docs.select(F.col(q(id_col)).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    order = [F.col("id").asc_nulls_last(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = checkpointed(rows.mapInArrow(_writer(folder, tokenizer, end_id, shard_tokens, match_added), MANIFEST))
    # two steps, so that no window holds more than the partitions or one partition's shards
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    upto = (Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("t").over(Window.orderBy("part").rowsBetween(*upto)), F.lit(0)).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(*upto))
    return manifest.withColumn("inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(parts), "part").select(
        *manifest.columns, (F.col("before") + F.col("inside")).alias("start"), F.lit(folder).alias("folder"))


DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long, shard string"


def _reader(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        for path, folder, start in zip(pdf["path"], pdf["folder"], pdf["start"]):
            fs, _ = open_fs(folder)
            with fs.open_input_file(path) as f:
                shard = WaveletShard(f)
                docs, lengths = shard.documents()
                ids = shard.decode()
            ends = np.cumsum(lengths)
            crcs = [zlib.crc32(ids[e - n:e].astype("<u4").tobytes()) for e, n in zip(ends, lengths)]
            yield pd.DataFrame({"doc_id": pd.array(docs, dtype="Int64"), "start": start + ends - lengths, "n_tokens": lengths,
                                "ids_crc32": crcs, "shard": path})


def read_shards(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32 and the shard's path."""
    n = max(1, manifest.count())
    return manifest.select("path", "folder", "start").repartition(n, "path").mapInPandas(_reader, DOCS)


def op2_wavelet_token_shards(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = write_shards(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), match_added=True)
    return read_shards(manifest)
