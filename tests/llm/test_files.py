"""Token shards, WARC archives and SentencePiece: exact round trips, brute force and odd cases."""

import gzip
import hashlib
import io
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tabsmith.llm import pieces, warc, wavelet

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [" ", "  ", "\n", "\t", "a", "b", "é", "'s", "1", ".", " \n", "日本", "<|endoftext|>", "\x85", "\xa0", "\x1c", "▁", "the", "tion", "😀"]


def _texts(n, seed, of=ODD):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(of) for _ in range(rnd.randint(0, 12))) for _ in range(n)]


def _library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_the_library(monkeypatch):
    monkeypatch.setattr(wavelet.Encoder, "KEPT", 50)  # the memo turns over often
    e = wavelet.Encoder(BPE)
    texts = _texts(4000, 1) + ["word " * 5000 + "end", "x" * 3000, "\0 nul"]
    for at in range(0, len(texts), 700):
        part = texts[at:at + 700]
        ids, each = e.encode(pa.array(part))
        want = [x + [0] for x in _library(part)]
        assert each.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_marks_after_a_word_need_no_look_at_the_word_again():
    e, sent = wavelet.Encoder(BPE), []
    real = e.whole
    e.whole = lambda texts, *more: sent.extend(texts) or real(texts, *more)
    texts = ["so word word, word. word### word' x", "a word! äöß, äöß word's word.word\nword, end,", "word, äöß."]
    for part in (texts, texts[::-1]):  # the second time from the kept words
        ids, each = e.encode(pa.array(part))
        want = [x + [0] for x in _library(part)]
        assert each.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    assert sum(t.split().count("word") for t in sent) == 1 and "word," not in " ".join(sent).replace("\nword,", "")


def _untouched(texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(BPE).encode_batch(texts, add_special_tokens=False)]


def test_encoder_matches_added_tokens_as_the_library_does():
    e = wavelet.Encoder(BPE, match_added=True)
    texts = ["a<|endoftext|>b", "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|> <|endoftext|>", "a\n<|endoftext|>\nb",
             "<|endoftext|", "plain words here", *_texts(4000, 2)]
    ids, each = e.encode(pa.array(texts))
    want = [x + [0] for x in _untouched(texts)]
    assert want[0] == [64, 50256, 65, 0]
    assert each.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_token_shards_query_equals_the_untouched_library(spark, docs_of, cases, tmp_path):
    rows = [(0, "a<|endoftext|>b"), *cases, *[(100 + i, t) for i, t in enumerate(_texts(200, 4))]]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(wavelet.op2_wavelet_token_shards(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    want = []
    for (i, _), x in zip(rows, _untouched([t or "" for _, t in rows])):
        want.append((str(i), len(x) + 1, zlib.crc32(np.array(x + [0], "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1000, 2), (70000, 300), (150000, 50257)])
def test_wavelet_matrix(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint16)
    out = io.BytesIO()
    wavelet.write_shard(out, ids, [None, 5] if n else [], np.array([n // 2, n - n // 2] if n else [], np.int64))
    s = wavelet.WaveletShard(out)
    assert (s.decode() == ids).all()
    assert s.documents()[0] == ([None, 5] if n else [])
    for i in [0, n // 3, n - 1] if n else []:
        t = int(ids[i])
        where = np.flatnonzero(ids == t)
        assert s.access(i) == t and s.count(t) == len(where)
        assert s.count(t, n // 4, n // 2) == ((where >= n // 4) & (where < n // 2)).sum()
        assert s.rank(t, i) == (where < i).sum() and s.select(t, len(where) // 2) == where[len(where) // 2]
    assert s.count(1 << 20) == 0
    with pytest.raises(IndexError):
        s.access(n)
    with pytest.raises(IndexError):
        s.select(top, 0)


def test_token_shards_round_trip(docs_of, cases):
    rows = cases + [(100 + i, t) for i, t in enumerate(_texts(200, 3))]
    manifest = wavelet.write_shards(docs_of(rows, extra=["start", "part"]), BPE, shard_tokens=500)
    got = wavelet.read_shards(manifest).collect()
    assert manifest.count() > 3
    text = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    ids = dict(zip({t or "" for _, t in rows}, _library(list({t or "" for _, t in rows}))))
    want, start = [], 0
    for i, t in text:
        x = np.array(ids[t or ""] + [0], "<u4")
        want.append((str(i), len(x), zlib.crc32(x.tobytes())))
        start += len(x)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.start for r in by_start] == np.cumsum([0] + [r.n_tokens for r in by_start])[:-1].tolist()
    assert [str(r.doc_id) for r in by_start] == [str(i) for i, _ in text]
    assert sum(r.n_tokens for r in got) == start


def test_token_shards_empty(docs_of):
    assert wavelet.read_shards(wavelet.write_shards(docs_of([]), BPE)).collect() == []


PAGES = [(1, "http://a/", "<p>one</p>"), (2, "http://b/ü x", "<p>one</p>"), (3, None, None), (4, "", ""), (5, "http://c/\r\nX: y", "é" * 9000),
         (None, "http://n/", "<p>one</p>"), (6, "http://d/", "<p>two</p>"), (6, "http://d/", "<p>two</p>"), (7, "http://e/", "\r\n\r\nWARC/1.1"),
         (8, "http://f/", "x" * 300000)]


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("shard", F.lit("mine"))


@pytest.mark.parametrize("least", [0, 5, 10**6])
def test_warc_round_trip(spark, least):
    manifest = warc.write_warc(_pages(spark, PAGES), min_revisit_bytes=least, shard_bytes=600, roll_bytes=400)
    got = warc.read_warc(manifest, with_payload=True).collect()
    assert len(got) == len(PAGES)
    groups = {}
    for p, _, h in PAGES:
        groups.setdefault(h or "", []).append(p)
    want, responses = [], 0
    for h, ps in groups.items():
        data = h.encode()
        top = max((p for p in ps if p is not None), default=None)
        first = True
        for p in sorted(ps, key=lambda p: p == top and 1 or 0, reverse=True):
            alone = len(data) < least or (p == top and first)
            first = first and p != top
            responses += alone
            want.append((str(p), len(data), warc.digest(data), "response" if alone else "revisit", str(None if alone else top)))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == sorted(want)
    assert {r.payload for r in got if r.payload is not None} == set(groups)
    assert len({r.record_id for r in got}) == len(got) and sum(r.record_type == "response" for r in got) == responses


def _files(manifest):
    out = {}
    for r in manifest.collect():
        fs, _ = warc.open_fs(r.folder)
        with fs.open_input_stream(r.path, compression=None) as f:
            out[r.path.rsplit("/", 1)[1]] = f.read()
        assert hashlib.sha256(out[r.path.rsplit("/", 1)[1]]).hexdigest() == r.sha256
    return out


def test_warc_bytes_do_not_depend_on_partitions(spark):
    a = _files(warc.write_warc(_pages(spark, PAGES).repartition(1), shard_bytes=600, roll_bytes=400))
    b = _files(warc.write_warc(_pages(spark, PAGES[::-1]).repartition(5), shard_bytes=600, roll_bytes=400))
    assert a == b and len(a) > 2
    whole = b"".join(gzip.decompress(x) for x in a.values())
    assert len(re.findall(rb"WARC/1.1\r\nWARC-Type: ", whole)) == len(PAGES)
    assert b"\nX: y" not in whole


def test_warc_damage_is_found():
    row = {"html": "abc", "revisit": False, "page": 1, "sha": "s", "url": "u"}
    raw = warc.record(row, "2024-01-01T00:00:00Z", 0)
    assert warc.parse(raw)["warc-type"] == "response"
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(warc.member(raw, 6)[:-9])))


def test_warc_ids_are_exact_over_64_bits(spark):
    big = [2**53 + 1, 2**53 + 3, 2**63 - 1, -(2**63) + 1, 5]
    for null in ([], [(None, "u", "<p>none</p>"), (None, None, "<p>same</p>")]):
        rows = [(i, "u", "<p>same</p>") for i in big] + [(2**53 + 2, "u", "<p>other</p>")] + null
        got = warc.read_warc(warc.write_warc(_pages(spark, rows), shard_bytes=20)).select("page_id", "refers_to", "record_type").collect()
        top = 2**63 - 1
        want = [(i, None if i == top else top, "response" if i == top else "revisit") for i in big] + [(2**53 + 2, None, "response")]
        want += [(None, None, "response"), (None, top, "revisit")] if null else []
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_warc_bounds_are_of_one_size(spark):
    keys = spark.createDataFrame([(i, f"{i:04d}", 10) for i in range(100)] + [(None, "z", 10)], "page long, sha string, bytes long")
    bounds = warc._bounds(keys.repartition(7), 100)
    assert [b[1] for b in bounds] == list(range(10, 100, 10)) + [0] and bounds[-1][0]
    assert warc._bounds(keys.limit(0), 100) == []


def test_warc_empty(spark):
    assert warc.read_warc(warc.write_warc(_pages(spark, []))).collect() == []


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(PIECES)


def test_pieces_equal_the_library(codec, spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t for t in _texts(3000, 5) if "▁" not in t and "\0" not in t]
    texts += [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if r.text]
    for t in texts:
        ids = codec.encode(t)
        assert ids.tolist() == sp.encode(t), t
        assert codec.decode(ids) == t


def test_pieces_round_trip_of_odd_texts(codec):
    for t in _texts(2000, 6) + ["", " ", "▁", " ▁ ", "\n", "\0", "x" * 5000, "a b " * 3000]:
        assert codec.decode(codec.encode(t)) == t


def test_search_does_not_depend_on_chunks(codec):
    text = ("▁thequickbrown" * 40 + "▁" * 30 + "日本aaaa") * 3
    whole = list(codec.search([text]))
    assert whole == list(codec.search(text))
    assert [codec._piece(n) for n in whole] == codec.merges(text)[0]


def test_search_commits_early(codec):
    fed = []

    def chunks():
        for i in range(2000):
            fed.append(i)
            yield "▁word"

    found = codec.search(chunks())
    next(found)
    assert len(fed) < 40  # ids come long before the text ends


def test_follows_is_what_the_merges_say(codec):
    rnd = random.Random(4)
    some = [p for p in codec.ids if len(p) < 7]
    near = [p for p in some if set(p) <= set("▁aeinst")]
    for pool in (some, near):
        for _ in range(4000):
            a, b = rnd.choice(pool), rnd.choice(pool)
            assert codec.follows(a, b) == (codec.merges(a + b)[0] == [a, b]), (a, b)


def test_unigram_rule_is_the_best_path(codec):
    uni = pieces.Codec(PIECES, "unigram")

    def best(text):
        score = [0.0] + [-1e18] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - uni.longest), end):
                n = uni.ids.get(text[start:end])
                if n is not None or end - start == 1:
                    score[end] = max(score[end], score[start] + (uni.scores[n] if n is not None else uni.lowest))
        return score[-1]

    rnd = random.Random(9)
    for _ in range(60):
        text = "▁" + "".join(rnd.choice("aeinorst▁日") for _ in range(rnd.randint(1, 120)))
        got = [uni._piece(n) for n in uni.search([text])]
        assert "".join(got) == text
        assert abs(sum(uni.scores[uni.ids[p]] if p in uni.ids else uni.lowest for p in got) - best(text)) < 1e-6


def test_decode_column(docs_of, cases):
    rows = pieces.encode_documents(docs_of(cases))
    rows = rows.withColumn("again", pieces.decode_column(PIECES)("ids")).collect()
    assert all(r.again == (r.text or "") for r in rows)


def test_encode_documents(docs_of, cases):
    rows = pieces.encode_documents(docs_of(cases, extra=["ids", "_text"])).collect()
    assert len(rows) == len(cases) and all(r.round_trip for r in rows)
    assert all(len(r.ids) == r.n_tokens for r in rows) and {r["_text"] for r in rows} == {"mine"}
    assert all(r.n_tokens == 0 for r in rows if not r.text)
    assert pieces.encode_documents(docs_of([])).collect() == []


def test_codec_rests_between_tasks():
    import pyarrow as pa

    from tabsmith.llm import pieces

    texts = ["the cat sat on the mat", "", "caf\u00e9 the\nthe  cat"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(texts)], names=["_row", "_text"])
    run = pieces._encoder(pieces.model_path(), "bpe")
    first, again = (list(run(iter([batch]))) for _ in range(2))
    model = pieces.codec(pieces.model_path(), "bpe")
    assert first == again and first[0].column("round_trip").to_pylist() == [True] * 3
    assert not model.young and not model.old
    task = run(iter([batch]))
    next(task)
    assert model.young
    task.close()  # a task that ends early rests too
    assert not model.young and not model.old


def test_decoding_makes_no_list_of_positions(monkeypatch):
    """Before, each plane was put back through two lists of positions, eight bytes for every id."""
    import io

    import numpy as np

    from tabsmith.llm import wavelet

    ids = np.random.default_rng(8).integers(0, 50_000, 200_000).astype("<u2")
    out = io.BytesIO()
    wavelet.write_shard(out, ids, [1], np.array([len(ids)]))
    monkeypatch.setattr(np, "flatnonzero", lambda *a: 1 / 0)
    assert (wavelet.WaveletShard(out).decode() == ids).all()
