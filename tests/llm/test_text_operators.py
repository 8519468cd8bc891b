"""Encoding, language ID, LM scoring, quality, counts: against the libraries, brute force or held-out rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import op01_token_counts as counts
from shelfwise.llm import op02_quality_mil as mil
from shelfwise.llm import op04_lm_scoring as lm
from shelfwise.llm import op05_sentencepiece as sp
from shelfwise.llm import op07_language_id as lid
from tests.conftest import SF_SMALL

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "b", " ", "  ", "\n", "▁", "é", "　", "①", "<s>", "</s>", "<0x0A>", "ﬁ", "\t", "\x00", "的", "the", " of", "🙂", "\r\n"]


# -- SentencePiece ---------------------------------------------------------------
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("piece", [3, 1 << 20])
def test_chunks_equal_the_library(monkeypatch, piece):
    monkeypatch.setattr(sp, "PIECE_CHARS", piece)
    monkeypatch.setattr(sp, "TABLE_CHUNKS", 50)
    rng, lib = random.Random(1), library()
    with open(MODEL, "rb") as f:
        table = sp.ChunkTable(f.read())
    for _ in range(1500):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 25)))
        ids, decoded = table.encode(text)
        expect = lib.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == expect
        assert decoded.decode() == lib.decode(expect)


def test_encode_and_decode_in_spark(spark):
    texts = ["Hello  world\nagain", "", None, "x" * 5000, "word " * 4000, "Hello  world\nagain"]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    lib = library()
    got = sp.encode(df, MODEL, ("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"))
    for r in got.collect():
        expect = lib.encode(texts[r["doc_id"]] or "", add_bos=True, add_eos=True)
        assert r["ids"] == expect and r["n_tokens"] == len(expect)
        assert r["ids_sha256"] == hashlib.sha256(np.array(expect, "<u4").tobytes()).hexdigest()
        assert r["decoded"] == lib.decode(expect)
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(expect).encode()).hexdigest()
    back = {r["doc_id"]: r["decoded"] for r in sp.decode(got.select("doc_id", "ids"), MODEL).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts))
    assert sp.encode(df.limit(0), MODEL).collect() == []


# -- language ID -------------------------------------------------------------------
def brute_kn(texts, order=4):
    """Interpolated Kneser-Ney by dictionaries: logp(context + unit)."""
    grams = [Counter() for _ in range(order + 1)]
    for t in texts:
        u = lid.units(t).tolist()
        grams[order].update(tuple(u[i:i + order]) for i in range(len(u) - order + 1))
    for o in range(order, 1, -1):
        grams[o - 1].update(g[1:] for g in grams[o])
    floor = 1 / (len({g[-1] for g in grams[order]}) + 1)
    stat = {}
    for o in range(1, order + 1):
        n1, n2 = sum(v == 1 for v in grams[o].values()), sum(v == 2 for v in grams[o].values())
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        total, kinds = Counter(), Counter()
        for g, c in grams[o].items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        stat[o] = d, total, kinds

    def p(g):
        o = len(g)
        if not o:
            return floor
        d, total, kinds = stat[o]
        if g[:-1] not in total:
            return p(g[1:])
        return max(grams[o][g] - d, 0) / total[g[:-1]] + d * kinds[g[:-1]] / total[g[:-1]] * p(g[1:])
    return p


def test_language_model_is_interpolated_kneser_ney(spark):
    texts = ["The cat sat on the mat", "a cat, a hat & the bat sat", "the rat ate that"]
    models = lid.train(spark.createDataFrame([("en", t) for t in texts] + [(None, "zzz"), ("", "tat"), ("en", None)],
                                             "lang string, text string"))
    assert list(models.langs) == ["", "en"]  # an empty name is a language, null is none
    p = brute_kn(texts)
    for probe in ["the cat", "hat that xylophone", "Ünïcödé the", "t"]:
        u = [32, 32, *lid.units(probe).tolist()]
        expect = -np.mean([math.log(p(tuple(u[i:i + 4]))) for i in range(len(u) - 3)])
        assert models.entropies([probe])[0, 1] == pytest.approx(expect, abs=1e-5)


def test_language_models_keep_a_share_per_language(spark):
    """200 languages over one alphabet, told apart by their syllables: a bounded model loses next to nothing."""
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def texts(lexicon, n, words):
        return [" ".join(rng.choice(lexicon) for _ in range(words)) for _ in range(n)]
    train, test = [], []
    for i in range(200):
        syllables = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 3))) for _ in range(25)]
        lexicon = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(300)]
        train += [(f"l{i:03d}", t) for t in texts(lexicon, 3, 200)]
        test += [(f"l{i:03d}", t) for t in texts(lexicon, 3, 12)]
    counts = lid.gram_counts(spark.createDataFrame(train, "lang string, text string")).cache()
    right = {}
    for keep in (300, 1 << 30):
        models = lid.build(counts, keep)
        e = models.entropies([t for _, t in test])
        right[keep] = np.mean([models.langs[b] == lang for b, (lang, _) in zip(e.argmin(1), test, strict=True)])
    counts.unpersist()
    assert counts.where("lang = 'l000'").count() > 600  # the bound leaves out more than half
    assert right[1 << 30] > 0.9 and right[300] >= right[1 << 30] - 0.01


def test_left_out_mass_goes_to_the_back_off(spark):
    texts = ["The cat sat on the mat", "a cat, a hat & the bat sat", "the rat ate that"]
    models = lid.train(spark.createDataFrame([("en", t) for t in texts], "lang string, text string"), keep=6)
    unit = np.unique(np.concatenate([lid.units(t) for t in texts]))
    assert len(models.p[4].keys) <= 6 and len(models.p[1].keys) == len(unit)
    for context in ("the", " ca", "xyz", "at "):
        head = np.uint64(0)
        for c in context:
            head = (head << np.uint64(16)) | np.uint64(ord(c))
        total = np.exp(models.score((head << np.uint64(16)) | unit)).sum()
        unknown = np.exp(models.score(np.array([(head << np.uint64(16)) | np.uint64(0x416)])))[0, 0]
        assert total + unknown == pytest.approx(1, abs=1e-4)  # all units and the one slot for any other


def test_language_id_held_out_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = [(10**6, None, "en"), (10**6 + 1, "", "en"), (10**6 + 2, "12 34 !?", "en"), (10**6 + 3, "🙂", None),
           (None, "the thing that", None), (10**6 + 4, "Ouwhea the of rend " * 40_000, None)]
    docs = docs.unionByName(spark.createDataFrame([(*r, "s") for r in odd], docs.schema))
    out = lid.held_out(docs["doc_id"], 4, 2)
    got = lid.identify(docs, docs.where(~out)).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in range(10**6, 10**6 + 4))
    assert by[10**6 + 4]["lang_pred"] == "en" and by[None]["lang_pred"] != "und"
    assert all(0 <= r["score"] <= 1 for r in got)
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [i for i in lang if i is not None and i < 10**6 and zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([by[i]["lang_pred"] == lang[i] for i in held]) >= 0.97


def test_language_id_without_training(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in lid.identify(docs, docs).collect()] == ["und"]


def test_language_model_and_calibration_take_all_texts(spark):
    rows = [(i, "ab" if i % 2 else "cd", ("abba baab " if i % 2 else "cddc dccd ") * 3 + "e" * (i % 5 + 1)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumn("half", lid.half(F.col("doc_id")))
    parts = [lid.gram_counts(docs.where(F.col("half") == k)) for k in (0, 1)]
    told = lid.losses(docs, [lid.build(p) for p in parts])
    got = told.collect()
    assert all(r["n"] == 60 for r in got if r["kind"] == 0) and sum(r["n"] for r in got if r["kind"] == 1) == 60
    temperature, limit = lid.calibrate(told)
    assert temperature in lid.TEMPERATURES and limit == max(r["at"] for r in got if r["kind"] == 1) * lid.LIMIT_STEP
    # more n-grams than the model once kept
    text = " ".join(chr(0x4E00 + i // 200) + chr(0x4E00 + i % 200) for i in range(34000))
    many = lid.gram_counts(spark.createDataFrame([("x", text)], "lang string, text string"))
    assert lid.probabilities(many).where("o = 4").count() == many.count() > 1 << 15



# -- LM scoring ----------------------------------------------------------------------
def test_lm_scores(spark, monkeypatch):
    monkeypatch.setattr(lm, "LEXICON", 1500)  # so that some words are joined
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r[0], r[1]) for r in rows] + [(10**6, None), (10**6 + 1, ""), (None, "the the"), (10**6 + 2, "NewWord newword")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n long").repartition(3)
    out = lm.held_out(df["doc_id"], 7, 2)
    got = {r["doc_id"]: r for r in lm.score(df, *lm.train(df.where(~out))).collect()}
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    c = Counter()
    for d, t in rows:
        if d is not None and zlib.crc32(str(d).encode()) % 7 != 2:
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    assert len(got) == len(rows)
    for d, t in rows:
        w = tokens(t)
        assert (got[d]["n_tokens"], got[d]["n_known"], got[d]["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), n)
        assert got[d]["base_score"] == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
    held = [r for d, r in got.items() if d is not None and zlib.crc32(str(d).encode()) % 7 == 2]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_is_a_distribution():
    """Head words, and per tail class its known words and one unknown, sum to one in any context."""
    words, n = [b"", *(f"w{i}".encode() for i in range(1500))], [50, *range(1600, 100, -1)]
    tail_n, tail_v = np.zeros(lm.TAIL), np.zeros(lm.TAIL)
    by = sorted(zip(words, n, strict=True), key=lambda x: (x[0] != b"", -x[1], x[0]))
    for w, c in by[lm.HEAD:]:
        tail_n[lm.tail_class(w)] += c
        tail_v[lm.tail_class(w)] += 1
    lex, model = lm.Lexicon(words, n, tail_n, tail_v, sum(n), len(n)).open(), lm.Model()
    rng = np.random.default_rng(0)
    model.w1 += rng.normal(size=model.w1.shape).astype(np.float32) * .1
    model.w2 += rng.normal(size=model.w2.shape).astype(np.float32) * .1
    t = np.arange(lm.HEAD + lm.TAIL)
    context = [np.full(len(t), x) for x in (5, 1030)]
    logs = lm.log_probs(model, lex, t, *context)
    mass = (10 ** logs[:lm.HEAD]).sum()
    mass += sum(10 ** logs[lm.HEAD + k] * (tail_n[k] + tail_v[k] + 1) for k in range(lm.TAIL))
    assert mass == pytest.approx(1, abs=1e-4)


def test_lm_learns_from_the_third_word_before():
    """The token after (a, c, d) is told by the word three before alone."""
    words = [b"", *(f"w{i:03d}".encode() for i in range(999))]
    lex = lm.Lexicon(words, [1000 - i for i in range(1000)], np.zeros(lm.TAIL), np.zeros(lm.TAIL), 500_500, 1000).open()
    a, b, c, d, p, q = 40, 80, 120, 160, 200, 300  # p and q lie in other classes
    model = lm.Model()
    t, u, v, x = lm.history([np.array([a, c, d, p] * 200 + [b, c, d, q] * 200, np.int32)])
    assert list(x[:5]) == [lm.SYMBOLS - 1] * 3 + [a, c]
    sums = lm.Sums()
    sums.add(model, lex, t, u, v, x)
    seen, expected = sums.parts[0]
    model.w1 += lm.RATE * (seen - expected) / (np.maximum(seen, expected) + lm.SMOOTH)
    one = lambda k: np.array([k])
    told, other = (lm.log_probs(model, lex, one(p), one(d), one(c), one(k))[0] for k in (a, b))
    assert told > other + 0.1


def test_lm_of_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    parts = lm.train(df)
    assert lm.score(df, *parts).collect() == []
    one = lm.score(spark.createDataFrame([(1, "a b")], df.schema), *parts).first()
    assert (one["n_tokens"], one["n_known"], one["train_tokens"], one["base_score"]) == (3, 0, 0, 0.0)


# -- quality -------------------------------------------------------------------------
def test_gradient_matches_differences():
    rng = np.random.default_rng(2)
    model = mil.AttentionMIL()
    x, starts, y = rng.normal(size=(9, mil.FEATURES)), np.array([0, 2, 5]), np.array([1.0, 0.0, 1.0])
    loss = lambda: -np.mean(y * np.log(p := model.forward(x, starts)["p"]) + (1 - y) * np.log(1 - p))
    grad = model.gradient(model.forward(x, starts), y, starts)
    for name, w in model.w.items():
        at = tuple(rng.integers(0, s) for s in w.shape)
        w[at] += 1e-5
        up = loss()
        w[at] -= 2e-5
        down = loss()
        w[at] += 1e-5
        assert grad[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-8)


def test_attention_weights_the_odd_passage():
    """Bags of positives with one telling passage: attention must learn to find it."""
    rng = np.random.default_rng(0)
    bags, y = [], []
    for i in range(300):
        b = rng.normal(size=(rng.integers(2, 9), mil.FEATURES)) * .3
        if i % 2:
            b[rng.integers(len(b)), :5] += 3
        bags.append(b)
        y.append(float(i % 2))
    model = mil.AttentionMIL().fit(bags, np.array(y))
    f = model.forward(bags[1], np.array([0]))
    assert f["p"][0] > 0.8 and f["a"].argmax() == bags[1][:, :5].sum(1).argmax()


def test_long_texts_are_scored_by_all_their_short_passages(monkeypatch):
    """Block pooling equals the softmax over all passages, and a repeated text scores as one of it."""
    rng = random.Random(4)
    model = mil.AttentionMIL()
    clean = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(400))[:1024]
    bad = "|".join("$9#" for _ in range(128))[:512]
    x = mil.features([clean[:512], clean[512:], bad])
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-2
    model.w["a"] *= 20
    texts = [clean * 200, clean, "", clean * 60 + bad + clean * 60, None, bad]
    bags = [[(t or "")[i: i + 512] for i in range(0, len(t or ""), 512)] or [""] for t in texts]
    expect = [model.forward(mil.features(b), np.array([0]))["p"][0] for b in bags]
    got = model.score(texts)
    assert got == pytest.approx(expect, abs=1e-9) and got[0] == pytest.approx(got[1], abs=1e-9)
    monkeypatch.setattr(mil, "BLOCK", 3)
    assert model.score(texts) == pytest.approx(expect, abs=1e-9)
    assert model.score([]).shape == (0,)


def test_quality_on_held_out_and_odd_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text", docs["n_chars"].alias("score"))
    odd = [(10**7, None), (10**7 + 1, ""), (None, "a text"), (10**7 + 2, "The and of " * 100_000)]
    docs = docs.unionByName(spark.createDataFrame([(*r, 0) for r in odd], docs.schema))
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 0), (10**7, None, 0)], labels.schema))
    model = mil.train(docs, labels)
    got = {r["doc_id"]: r["p"] for r in mil.classify(docs, model, "p").collect()}
    assert len(got) == docs.count() and all(0 <= p <= 1 for p in got.values())
    held = [(r["doc_id"], r["quality"]) for r in labels.collect() if r["doc_id"] is not None and r["quality"] is not None
            and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert np.mean([(got[i] >= 0.5) == q for i, q in held]) >= 0.95
    kept = mil.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(p >= 0.5 for p in got.values())


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert mil.keep_good(docs, none).count() == 1
    assert mil.keep_good(docs.limit(0), none).count() == 0


# -- token counts ----------------------------------------------------------------------
def test_counts_equal_the_tokenizer(spark):
    import base64

    import tiktoken
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["Hello world", "", None, "<|endoftext|> é " * 50, "word " * 20_000]
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, N_Tokens long")
    out = counts.count_tokens(df, path, pattern)
    assert out.columns == ["doc_id", "n_tokens"]
    got = {r["doc_id"]: r["n_tokens"] for r in out.collect()}
    assert got == {i: len(enc.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}


CHANGES = "doc_id long, op string, source string, lang string, tokenizer string, n_tokens long, text string"


def test_rollup_follows_a_dictionary(spark, tmp_path):
    rng, held = random.Random(4), {}
    rollup = counts.TokenRollup(spark, str(tmp_path))
    for b in range(4):
        rows = []
        for d in rng.sample([None, *range(25)], 12):
            op = rng.choice(["insert", "delete", "revise"])
            row = (d, op, rng.choice(["s", "t", None]), rng.choice(["en", None]), "v1", rng.randint(0, 50), "x")
            rows += [row] * rng.choice([1, 2])
            if op == "delete":
                held.pop(d, None)
            else:
                held[d] = row[2:6]
        df = spark.createDataFrame(rows, CHANGES)
        assert rollup.commit(f"b{b}", df) is True
        assert rollup.commit(f"b{b}", df) is False
    expect = Counter()
    for s, lang, tok, n in held.values():
        expect[s, lang, tok, "docs"] += 1
        expect[s, lang, tok, "tokens"] += n
    got = {}
    for r in rollup.totals().collect():
        got[r["source"], r["lang"], r["tokenizer"], "docs"] = r["n_docs"]
        got[r["source"], r["lang"], r["tokenizer"], "tokens"] = r["n_tokens"]
    assert got == {k: got.get(k, 0) if not v else v for k, v in expect.items()}


def test_rollup_survives_a_batch_that_died(spark, tmp_path):
    rollup = counts.TokenRollup(spark, str(tmp_path))
    assert rollup.totals().collect() == []
    rollup.commit("a", spark.createDataFrame([(1, "insert", "s", "en", "v", 5, "x")], CHANGES))
    half = spark.createDataFrame([(9, "v", True, "s", "en", 100, 2)],
                                 "doc_id long, tokenizer string, alive boolean, source string, lang string, n_tokens long, number int")
    half.write.parquet(f"{tmp_path}/ledger/b")  # its commit was never written
    assert rollup.totals().first()["n_tokens"] == 5
    rollup.commit("b", spark.createDataFrame([(2, "insert", "s", "en", "v", 7, "x"), (3, "delete", "s", "en", "v", 7, "x")], CHANGES))
    rollup.commit("c", spark.createDataFrame([], CHANGES))
    assert [(r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect()] == [(2, 12)]
