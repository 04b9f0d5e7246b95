"""Pieces, token files, top-k and the pipeline."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weirline.llm import sentence_pieces as sp
from weirline.llm import token_files as tf
from weirline.llm import topk
from weirline.llm.queries import vocabulary

PIECES, WORDS = vocabulary("piece_bpe_32k.model"), vocabulary("word_bpe_49k.json")
TEXTS = ["", None, "Hello world, hello again.", "  two  spaces \n\n tabs\t", "日本語 🎉 mixed", "x" * 120, " " * 40, "word " * 3, "▁ literal ▁▁x", "\x00 nul", "été naïve"]


@pytest.fixture(scope="module")
def pieces():
    return sp.Pieces(PIECES)


def test_without_dropout_pieces_are_the_librarys(pieces):
    texts = [t for t in TEXTS if t and "▁" not in t]
    got = sp.encode_batch(pieces, texts, [0] * len(texts), 0.0)
    assert [x.tolist() for x in got] == pieces.model.encode(texts)


def test_dropout_varies_and_decodes(pieces):
    keys = [sp.document_key(s, 1) for s in range(20)]
    many = sp.encode_batch(pieces, ["Segmentation of internationalization varies."] * 20, keys, 0.3)
    assert len({tuple(x) for x in many}) > 10
    again = sp.encode_batch(pieces, ["Segmentation of internationalization varies."] * 20, keys, 0.3)
    assert all((a == b).all() for a, b in zip(many, again))
    texts = [t or "" for t in TEXTS]
    for dropout in (0.0, 0.1, 0.9, 1.0):
        ids = sp.encode_batch(pieces, texts, list(range(len(texts))), dropout)
        assert pieces.model.decode([x.tolist() for x in ids]) == texts


def test_long_words_take_the_same_agenda(pieces, monkeypatch):
    texts = [t for t in TEXTS if t] + ["extraordinarily unbelievable counterintuitive"] * 3
    keys = list(range(len(texts)))
    want = sp.encode_batch(pieces, texts, keys, 0.2)
    monkeypatch.setattr(sp, "LONGEST", 0)
    assert all(a.tolist() == b.tolist() for a, b in zip(sp.encode_batch(pieces, texts, keys, 0.2), want))


def frame(spark, texts):
    return spark.createDataFrame([*enumerate(texts), (None, "null id"), (2, "again")], "doc_id long, text string").withColumns(
        {n: F.lit(1) for n in ("ids", "part", "chunk", "tie")}
    )


def test_pieces_as_tables(spark):
    df = frame(spark, TEXTS)
    assert df.count() == sp.round_trip(df, PIECES).filter("lossless").count()
    back = sp.decode(sp.encode(df, PIECES, 0.2, 3), PIECES).collect()
    want = [(i, t or "") for i, t in [*enumerate(TEXTS), (None, "null id"), (2, "again")]]
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(want, key=str)
    assert sp.round_trip(df.limit(0), PIECES).count() == 0


@pytest.mark.parametrize("n", [0, 1, 257, 4096, 9000])
def test_coder_round_trips(n, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK", 5000)
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 65536, n), rng.zipf(1.3, n) % 65536, np.full(n, 7), np.arange(n) % 11):
        assert (tf.decode_ids(tf.encode_ids(ids)) == ids).all()
    wide = rng.integers(0, 1 << 20, n)
    assert (tf.decode_ids(tf.encode_ids(wide, 20)) == wide).all()


def test_coder_renews_and_halves(monkeypatch):
    monkeypatch.setattr(tf, "TOTAL", 1 << 12)
    ids = np.random.default_rng(2).zipf(1.2, 60_000) % 700
    assert (tf.decode_ids(tf.encode_ids(ids)) == ids).all()


def test_order_0_finds_ids_without_searching_all():
    """Ids by slot come from a table and few steps, as the search gives them; a block of 4 million ids takes few steps."""
    model, rng = tf.Model(50_000, 1), np.random.default_rng(5)
    for counts in (model.counts, rng.zipf(1.3, 50_000) % 9_000 + 1, np.where(np.arange(50_000) == 7, 1 << 20, 1)):
        model.counts = counts.astype(np.int64)
        model._renew()
        slots = np.concatenate([rng.integers(0, model.total, 20_000), model.sums[:-1], model.sums[1:] - 1])
        assert (model.ids_at(slots) == np.searchsorted(model.sums, slots, "right") - 1).all()
    assert -(-tf.BLOCK // min(tf.STRETCHES, tf.BLOCK // tf.LEAST_STEPS)) <= 512


def test_coder_beats_static_order_0_and_deflate():
    """On the ids of real texts."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    ids = np.frombuffer(b"".join(tf.Tokenizer(WORDS).encode(texts, 2)), "<u4")
    counts = np.unique(ids, return_counts=True)[1]
    order_0 = -(counts * np.log2(counts / len(ids))).sum() / 8
    size = len(tf.encode_ids(ids))
    assert size < 0.97 * order_0 and size < 0.9 * len(zlib.compress(ids.astype("<u2").tobytes(), 9))


def test_tokenizer_equals_the_library(monkeypatch):
    monkeypatch.setattr(tf, "HELD", 500)
    known, rng = tf.Tokenizer(WORDS), np.random.default_rng(4)
    parts = [*"abXYZ'stdvemlr019.,!?-_<|>\u00e9\u00c9\u00df\u00c0\u00f6\u00d7\u00f7\u00ff\u00aa\u00b2 \n\t\x1c\x85\xa0\u0301\u0130\u03a3\u4e2d", "<|endoftext|>", "'LL", "It's", "</w>"]
    assert known.plain
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(1, 30)))
        want = known.library.encode(text, add_special_tokens=False).ids
        assert known.encode([text], 2) == [np.array([*want, 2], "<u4").tobytes()], text


def test_coder_compresses_and_checks():
    ids = np.tile(np.random.default_rng(1).integers(0, 49408, 200), 40)
    raw = tf.encode_ids(ids)
    assert len(raw) < 0.35 * 2 * len(ids)
    broken = bytearray(raw)
    broken[len(raw) // 2] ^= 1
    with pytest.raises(ValueError):
        tf.decode_ids(bytes(broken))
    with pytest.raises(ValueError):
        tf.encode_ids([1 << 16])


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = [*TEXTS, "a\x1cb c", "<|endoftext|> X", "É ́a  b", "ΑΣ x"]
    df, path = frame(spark, texts), f"file://{tmp_path}/out"
    tf.write(df, WORDS, path)
    files = spark.read.schema(tf.FILE).parquet(path)
    rows = tf.placed(files, tf.digests(files)).orderBy("start").collect()
    library = Tokenizer.from_file(WORDS)
    want = {}
    for i, t in [*enumerate(texts), (None, "null id"), (2, "again")]:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    assert [r.doc_id for r in rows] == [None, 0, 1, 2, 2, *range(3, len(texts))]
    at = 0
    for r in rows:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        at += r.n_tokens
    assert {r.doc_id: len(r.ids) for r in tf.read(files).collect()}[None] == want[None][0][0]
    tf.write(df.limit(0), WORDS, f"{path}-empty")
    assert tf.digests(spark.read.schema(tf.FILE).parquet(f"{path}-empty")).count() == 0


def brute_top_k(vectors):
    good = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in vectors
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = {}
    for q, a in good:
        if q % 20 == 0:
            scored = sorted((-int(a @ b), i) for i, b in good if i != q and len(a) == len(b))[:20]
            if scored:
                want[q] = [(k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    return want


def top_k_of(df, **options):
    got = {}
    for r in topk.top_k(df, df.filter("vec_id % 20 = 0"), **options).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(x) for q, x in got.items()}


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_top_k(spark, monkeypatch, limit):
    """Queries broadcast, and in the cells of a grid."""
    monkeypatch.setattr(topk, "ROWS", 64)
    monkeypatch.setattr(topk, "QUERIES", 8)
    monkeypatch.setattr(topk, "CELL_BYTES", 4000)
    rng = np.random.default_rng(0)
    vectors = [(k, (rng.normal(size=8) * (1 + 5 * (k % 7 == 0))).round(1).tolist()) for k in range(500)]
    vectors += [(500, None), (501, [1.0, None] * 4), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (504, vectors[4][1]), (None, vectors[5][1]),
                (504, vectors[4][1]), (520, [0.0] * 8), (540, [1.0, 2.0]), (541, [3.0, 1.0]), (560, []), (580, [5e7, 1.0]), (581, [100.0, 2.0])]
    vectors += [(1000 + k, (rng.normal(size=24) * 0.8 ** np.arange(24)).round(2).tolist()) for k in range(300)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumns({n: F.lit(1) for n in ("dim", "v", "length", "block")})
    assert top_k_of(df, broadcast_bytes=limit) == brute_top_k(vectors)
    assert topk.top_k(df.limit(0), df.limit(0), broadcast_bytes=limit).count() == 0


def test_top_k_of_many_dimensions(spark):
    """A block for each dimension, more of them than a few."""
    rng = np.random.default_rng(1)
    vectors = [(k, rng.normal(size=1 + k % 12).round(2).tolist()) for k in range(600)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    assert top_k_of(df) == top_k_of(df, broadcast_bytes=0) == brute_top_k(vectors)


def test_pruning():
    """What is scored in full: little where lengths or axes are skewed, and never at the cost of a result."""
    rng = np.random.default_rng(2)
    shares = {}
    for name, v in {
        "lengths": rng.normal(size=(4000, 32)) * rng.pareto(1.5, 4000)[:, None],
        "axes": rng.normal(size=(4000, 32)) * 0.6 ** np.arange(32),
        "even": rng.normal(size=(4000, 32)),
    }.items():
        v = np.floor(64 * v)
        v = v[np.argsort(-(v * v).sum(1))]
        ids, axes = np.arange(len(v)), np.linalg.eigh(v.T @ v)[1][:, ::-1]
        picked = rng.permutation(len(v))[:96]
        q = topk.Queries(picked, v[picked], np.full(96, -np.inf), axes, 10)
        for a in range(0, len(v), 500):
            q.meet(ids[a : a + 500], v[a : a + 500], v[a : a + 500] @ axes)
        scores = v[picked] @ v.T
        scores[np.arange(96), picked] = -np.inf
        want = np.sort(scores, axis=1)[:, ::-1][:, :10]
        got = q.rows().groupby("query_id")["score"].apply(lambda s: sorted(s, reverse=True))
        assert all(got[i] == w for i, w in zip(picked, want.astype(int).tolist()))
        shares[name] = q.full / q.all
    assert shares["lengths"] < 0.3 and shares["axes"] < 0.5, shares


def test_pipeline_stages(spark, tmp_path):
    words = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore".split()
    rng = np.random.default_rng(0)
    texts = {k: " ".join(rng.choice(words, 80)) for k in range(40)}
    line = "Shared boilerplate line that is long enough to go away."
    texts |= {k: f"{texts[k]}\n{line}" for k in range(6)}
    item = " ".join(rng.choice(words, 14))
    texts |= {50: texts[20], 51: texts[21].replace("lorem", "lorem", 1), 60: f"{texts[22][:200]} {item}", 70: "@@## %%^^ QQ!! " * 30}
    rows = [(k, t, "la", "s", len(t)) for k, t in texts.items()] + [(80, None, "la", "s", None), (81, "", None, None, 0)]
    rows += [rows[20], (None, f"{texts[23][:200]} {item} {texts[24][:90]}", "la", "s", None), (None, "@@## %%^^ QQ!! " * 30, "la", "s", 450)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sf = f"file://{tmp_path}"
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    kept = corpus_pipeline.keep_quality(spark, docs, sf)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(texts) - {70} | {80, 81, None}
    assert kept.filter("doc_id is null").count() == 1
    lines = {r.doc_id: r.text for r in corpus_pipeline.drop_common_lines(spark, docs, sf).collect()}
    assert [line in (lines[k] or "") for k in range(6)] == [False] * 5 + [True] and lines[30] == texts[30] and lines[80] is None
    copies = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf).collect()]
    assert copies.count(20) == 1
    copies = set(copies)
    assert {50, 51, 81} & copies == set() and set(range(40)) <= copies
    clean = {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, sf).collect()}
    assert 60 not in clean and set(range(40)) <= clean
    assert corpus_pipeline.drop_contaminated(spark, docs, sf).filter("doc_id is null").count() == 1
    out = corpus_pipeline.run(spark, sf)
    assert sorted(r.doc_id for r in out.collect()) == [*range(40), 80] and out.filter("not lossless").count() == 0
    empty = docs.limit(0)
    assert all(f(spark, empty, sf).count() == 0 for _, f in corpus_pipeline.STAGES)


def test_pipeline_drops_what_fingerprints_link(spark, tmp_path):
    """Texts of one fingerprint, as what they repeat outweighs the rest, whose sets of shingles differ."""
    texts = [f"{'alpha beta gamma ' * 200}{' '.join(f'{c}{k}' for k in range(20))}" for c in "xyz"] + ["quite another text of its own"]
    rows = [(3, texts[0]), (1, texts[1]), (2, texts[2]), (2, texts[2]), (None, texts[0]), (4, texts[3]), (4, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.drop_near_copies(spark, docs, f"file://{tmp_path}").collect()
    assert sorted(map(tuple, got)) == [(1, texts[1]), (4, texts[3])]
