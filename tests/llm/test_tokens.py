"""Token counts and packing against the tokenizer libraries on whole texts."""

import random
import zlib

import numpy as np
import pytest

from quarry.llm import bpe, packing, token_counts
from quarry.llm.common import scratch

public_tokenizers = pytest.importorskip("public_tokenizers")
FILE = "byte_bpe_50k.json"
SCHEMA = "doc_id long, text string, n_tokens string, length string"


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(FILE))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def odd_texts():
    rnd = random.Random(3)
    chars = [" ", " ", " ", "\n", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "a", "B", "é",
             "1", "'s", "'", "!", "<|endoftext|>", "中", "👍", "́", "don't", "_"]
    out = ["", " ", "\n", "a\nb", "a\n b", "a  b", "a   b ", " a", "<|endoftext|>", "x <|endoftext|> y\n<|endoftext|>\nz"]
    out += ["".join(rnd.choice(chars) for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    out += ["".join(chr(c) for c in range(k, k + 64) if not 0xD800 <= c < 0xE000) for k in range(1, 0x3100, 64)]
    return out


def test_pieces_give_the_library_ids():
    encoder, ids = bpe.Encoder(public_tokenizers.path(FILE)), library()
    texts = odd_texts()
    for text, got in zip(texts, encoder.ids(texts)):
        assert np.frombuffer(got, "<u4").tolist() == ids(text), repr(text)


def test_cache_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 5)
    encoder, ids = bpe.Encoder(public_tokenizers.path(FILE)), library()
    for k in range(4):
        texts = [f"one two {k} {i} three" for i in range(20)]
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.ids(texts)] == [ids(t) for t in texts]
        assert len(encoder.first) <= 5 and len(encoder.later) <= 5


def test_sentencepiece_model():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    plain = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["Hello  there\nyou", "", "été"]
    assert [np.frombuffer(b, "<u4").tolist() for b in bpe.Encoder(path).ids(texts)] == [plain.encode(t) for t in texts]


def rows():
    texts = [None, "", "a b", "a b", "Hello there", "long " * 3000, "x" * 5000] + odd_texts()[:40]
    return [(i, t, "clash", "clash") for i, t in enumerate(texts)] + [(3, "a b", "clash", "clash"), (None, "a b", "", "")]


def test_counts_and_cache(spark, monkeypatch):
    ids, cache, place = library(), scratch(spark, "test-cache"), bpe.locator(FILE)
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    want = sorted(((d, len((t or "").encode()), len(ids(t or ""))) for d, t, *_ in rows()), key=str)
    first = token_counts.count_tokens(docs, cache, place)
    assert sorted(map(tuple, first.collect()), key=str) == want
    folder = f"{cache}/tokenizer={token_counts.version(place())}"
    assert spark.read.parquet(folder).count() == len({t or "" for _, t, *_ in rows()})
    # all is known now: nothing is encoded; one new text is encoded alone
    encoded = []
    real = token_counts._encode
    monkeypatch.setattr(token_counts, "_encode", lambda texts, loc: encoded.append(texts.count()) or real(texts, loc))
    assert sorted(map(tuple, token_counts.count_tokens(docs, cache, place).collect()), key=str) == want
    more = docs.unionByName(spark.createDataFrame([(900, "quite new", "", ""), (901, "quite new", "", "")], SCHEMA))
    monkeypatch.setattr(token_counts, "BROADCAST_ROWS", 0)
    assert token_counts.count_tokens(more, cache, place).where("doc_id >= 900").count() == 2
    assert encoded == [1]
    # a wrong stored count shows that the cache answers
    assert token_counts.count_tokens(docs.limit(0), cache, place).collect() == []


def check_packing(got, docs, length, end_id):
    ids = library()
    want = {}
    for d, t, *_ in docs:
        seq = np.array(ids(t or "") + [end_id], "<u4")
        at, size, piece = 0, (len(seq) - 1) % length + 1, 0
        while at < len(seq):
            want.setdefault((d, piece, at, size, zlib.crc32(seq[at:at + size].tobytes())), []).append(1)
            at, size, piece = at + size, length, piece + 1
    have = {}
    for r in got:
        have.setdefault(tuple(r[:5]), []).append(1)
    assert have == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, size in sorted(places):
            assert offset == end
            end += size
        assert end <= length
    return bins


def test_pack_whole_documents(spark):
    docs = rows()
    got = packing.pack(spark.createDataFrame(docs, SCHEMA).repartition(3), bpe.locator(FILE), 64).collect()
    bins = check_packing(got, docs, 64, 2)
    assert len(bins) <= 1.02 * sum(r.length for r in got) / 64 + 1
    assert packing.pack(spark.createDataFrame([], SCHEMA), bpe.locator(FILE)).collect() == []


def test_crossover_keeps_every_piece():
    rnd = random.Random(1)
    counts = {rnd.randint(1, 100): rnd.randint(1, 50) for _ in range(60)}
    people = [packing.founder(counts, 100, rnd, i == 0) for i in range(6)]
    people += [packing.crossover(rnd.choice(people), rnd.choice(people), counts, 100, rnd) for _ in range(30)]
    for packed in people:
        have = {}
        for pattern, n in packed:
            assert sum(pattern) <= 100
            for size in pattern:
                have[size] = have.get(size, 0) + n
        assert have == counts


def test_islands_beat_or_equal_best_fit(spark):
    rnd = random.Random(8)
    counts = {s: rnd.randint(1, 4) for s in rnd.sample(range(200, 700), 160)}
    best = packing.evolve(spark, counts, 1000)
    assert packing.fitness(best, 1000) <= packing.fitness(packing.best_fit([], counts, 1000), 1000)


def test_islands_evolve_side_by_side(spark):
    from pyspark.sql import functions as F

    people = spark.range(packing.ISLANDS * 7).select((F.col("id") % packing.ISLANDS).cast("int").alias("island"))
    tasks = packing.apart(people).select("island", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(tasks) == packing.ISLANDS and len({r.task for r in tasks}) > packing.ISLANDS // 2
    evolved = packing.apart(people).groupBy("island").applyInPandas(lambda rows: rows, "island int")
    assert evolved._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
