"""Operators 11 to 13: against brute force, on odd rows, and in closed form."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import op11_merkle_manifest as op11
from shelfwise.llm import op12_url_filter as op12
from shelfwise.llm import op13_periodic_runs as op13

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ 11


def leaf_of(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        now = out[-1]
        out.append([sha("".join(now[k: k + 8])) for k in range(0, len(now), 8)])
    return out


def path_of(levels, i):
    for level in levels[:-1]:
        run = level[i // 8 * 8: i // 8 * 8 + 8]
        yield i % 8, [d for k, d in enumerate(run) if k != i % 8]
        i //= 8


def manifest_by_hand(rows):
    """Recursive hashing of the whole list, without blocks, positions or log."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        ordered = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])), k)
                         for k, r in enumerate(groups[lang]))
        groups[lang] = [groups[lang][k] for _, k in ordered]
        trees[lang] = levels_of([leaf_of(r, r["text"]) for r in groups[lang]])
    top = levels_of([trees[lang][-1][0] for lang in langs])
    out = []
    for g, lang in enumerate(langs):
        for i, r in enumerate(groups[lang]):
            steps = [*path_of(trees[lang], i), *path_of(top, g)]
            digest = trees[lang][0][i]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                digest = leaf_of(r, r["text"].translate(LOWER))
            for k, others in steps:
                digest = sha("".join(others[:k] + [digest] + others[k:]))
            out.append((r["doc_id"], trees[lang][0][i], trees[lang][-1][0], top[-1][0],
                        sha("".join(d for _, others in steps for d in others)), digest, digest == top[-1][0]))
    return out


def made_rows(sizes):
    rows, at = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append({"doc_id": at * 7 % 10007, "text": f"Text {at} Ünï" * (at % 4), "lang": lang,
                         "source": None if at % 5 == 0 else f"src{at % 3}", "n_chars": at})
            at += 1
    return rows


def proofs_of(spark, rows):
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in DOCS.split(", ")) for r in rows], DOCS)
    return [tuple(r) for r in op11.proofs(op11.build(df.repartition(5))).collect()]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


def test_position_is_the_postorder():
    for n in range(1, 140):
        log, height = [], 0
        while 8 ** height < n:
            height += 1

        def complete(level, index, last):
            log.append((level, index))
            if level < height and (index % 8 == 7 or last):
                complete(level + 1, index // 8, last)

        for i in range(n):
            complete(0, i, i == n - 1)
        assert [op11.position(level, index, n) for level, index in log] == list(range(len(log)))


def test_log_is_in_completion_order():
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(20)]
    log = op11.append_log(leaves, False)
    levels = levels_of([d.hex() for d in leaves])
    for h, level in enumerate(levels):
        for j, digest in enumerate(level):
            p = 32 * op11.position(h, j, 20)
            assert log[p: p + 32].hex() == digest
    assert len(log) == 32 * sum(map(len, levels))


@pytest.mark.parametrize("sizes", [
    {"en": 1300, None: 9, "de": 1, "": 2, "Z": 65, "é": 64},  # three blocks, a lone leaf, null and empty lang
    {"en": 513}, {"en": 8}, {None: 1},
])
def test_manifest_equals_hashing_by_hand(spark, sizes):
    rows = made_rows(sizes)
    assert in_order(proofs_of(spark, rows)) == in_order(manifest_by_hand(rows))


def test_manifest_with_many_langs(spark):
    rows = made_rows({f"l{k}": 1 + k % 3 for k in range(600)})  # the tree over subroots has two rounds
    assert in_order(proofs_of(spark, rows)) == in_order(manifest_by_hand(rows))


def test_manifest_odd_rows(spark):
    base = made_rows({"en": 30, None: 3})
    rows = base + [dict(base[0], text="other"), dict(base[1]), dict(base[1]),
                   {"doc_id": None, "text": None, "lang": "en", "source": None, "n_chars": None},
                   {"doc_id": 5, "text": "A" * 300_000, "lang": None, "source": "s", "n_chars": 0},
                   {"doc_id": 6, "text": "", "lang": "en", "source": "", "n_chars": -4}]
    assert in_order(proofs_of(spark, rows)) == in_order(manifest_by_hand(rows))
    assert proofs_of(spark, []) == []


def test_manifest_ignores_extra_columns_and_tells_tampering(spark):
    rows = made_rows({"en": 70})
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in DOCS.split(", ")) for r in rows], DOCS)
    clash = df.selectExpr("*", "1 as key", "'x' as leaf", "2 as i", "3 as n", "4 as block", "5 as root")
    got = op11.proofs(op11.build(clash)).collect()
    assert in_order(tuple(r) for r in got) == in_order(manifest_by_hand(rows))
    changed = {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
               and r["text"] != r["text"].translate(LOWER)}
    assert changed and {r["doc_id"] for r in got if not r["verified"]} == changed


def test_manifest_nodes_and_subroots(spark):
    rows = made_rows({"en": 700, "de": 3})
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in DOCS.split(", ")) for r in rows], DOCS)
    m = op11.build(df)
    by_lang = {"en": [r for r in rows if r["lang"] == "en"], "de": [r for r in rows if r["lang"] == "de"]}
    got = {}
    for r in m.nodes().collect():
        got.setdefault(r["lang"], {})[r["level"], r["index"]] = (r["position"], r["digest"])
    for lang, own in by_lang.items():
        levels = levels_of([leaf_of(r, r["text"]) for r in sorted(own, key=lambda r: r["doc_id"])])
        assert {k: v[1] for k, v in got[lang].items()} == {(h, j): d for h, lv in enumerate(levels) for j, d in enumerate(lv)}
        assert sorted(v[0] for v in got[lang].values()) == list(range(sum(map(len, levels))))
    assert {(r["lang"], r["n_leaves"]) for r in m.subroots().collect()} == {("en", 700), ("de", 3)}
    assert m.root().count() == 1


# ------------------------------------------------------------------ 12


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^/?#]*([^?#]*)", rest)[1]


def slots_of(url):
    host, path = parts_of(url)
    out = set()
    for mark, t in (("h", f"^{host}$" if host else ""), ("p", path)):
        for n in op12.GRAMS:
            out |= {zlib.crc32((mark + t[i: i + n]).encode()) % op12.SLOTS for i in range(len(t) - n + 1)}
    return out


URLS = [None, "", "no scheme/path", "http://", "http://NET/x", "https://a.b.NET/de/1?x=/en/", "https://net", "http://xnet/en/",
        "https://example.net/en/", "http://www.EXAMPLE.net/en/5#x", "https://notexample.net/en/5", "https://example.net/EN/5",
        "ftp://q.example.com/de/1", "https://example.com/de", "https://blog.org/fr/1", "https://org/fr/", "https://a.org/fr",
        "http://user:pw@host.org:80/fr/x", "https://free-casino.com/slots", "https://x.org?y=://z/fr/", "http://ünï.org/fr/é",
        "a://b://c.net/d", "http://" + "a" * 50_000 + ".net/x", "http://x.com/" + "pills/" * 10_000]


def rule_of(url):
    host, path = parts_of(url)
    best = None
    for verdict, rule in op12.RULES:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best


def test_url_filter_equals_brute_force(spark):
    labelled = spark.createDataFrame([(u, y) for u, y in op12.LABELLED], "url string, junk int")
    weights = op12.train(labelled, 3)
    want = [0.0] * (op12.SLOTS + 1)
    found = [(slots_of(u), y) for u, y in op12.LABELLED]
    for _ in range(3):
        grad = [0.0] * len(want)
        for s, y in found:
            x = op12.LENGTH / max(len(s), 1) ** 0.5
            p = 1 / (1 + 2.718281828459045 ** -(x * sum(want[k] for k in s) + want[-1]))
            for k in s:
                grad[k] += (p - y) * x / len(found)
            grad[-1] += (p - y) / len(found)
        want = [w - op12.RATE * (g + (op12.L2 * w if k < op12.SLOTS else 0)) for k, (w, g) in enumerate(zip(want, grad))]
    assert weights == pytest.approx(want, abs=1e-9)
    df = spark.createDataFrame([(k, u, "kept") for k, u in enumerate(URLS)], "page_id long, url string, verdict string")
    rows = {r["page_id"]: r for r in op12.judge(df.withColumn("other", F.lit(1)), weights).collect()}
    assert len(rows) == len(URLS)
    for k, url in enumerate(URLS):
        s = slots_of(url)
        m = op12.LENGTH / max(len(s), 1) ** 0.5 * sum(want[j] for j in s) + want[-1]
        rule = rule_of(url)
        assert (rows[k]["host"], rows[k]["path"]) == parts_of(url)
        assert rows[k]["rule"] == (rule and rule[1])
        assert rows[k]["verdict"] == (rule[0] if rule else "block" if m >= 0 else "allow")
        assert rows[k]["other"] == 1


def test_url_filter_learns_junk(spark):
    weights = op12.train(op12.labelled_table(spark))
    new = [("https://royal-casino.co/spin", 1), ("http://buy-pills-now.io/en/3", 1), ("https://adult-tube.co/v/9", 1),
           ("http://m.sport-bets.io/live", 1), ("https://library-books.co/en/12", 0), ("http://weather-today.io/fr/4", 0),
           ("https://blog.thinker.co/es/100", 0), ("https://garden-history.io/en/7", 0)]
    df = spark.createDataFrame(new, "url string, junk_label int")
    got = op12.judge(df, weights, rules=()).collect()
    assert all((r["junk"] >= 0.5) == (r["junk_label"] == 1) for r in got)


def test_url_filter_edges(spark):
    empty = spark.createDataFrame([], "url string, junk int")
    weights = op12.train(empty)
    assert weights == [0.0] * (op12.SLOTS + 1)
    pages = spark.createDataFrame([(1, "http://a.fr/")] * 2, "page_id long, url string")
    assert [r["verdict"] for r in op12.judge(pages, weights).collect()] == ["block"] * 2
    assert op12.judge(pages.limit(0), weights).collect() == []
    nulls = spark.createDataFrame([(None, 1), ("http://a.fr/x", None)], "url string, junk int")
    assert op12.train(nulls, 1)[-1] == pytest.approx(op12.RATE / 2)
    with pytest.raises(ValueError):
        op12.judge(pages, weights, rules=[("allow", "no-slash")])
    tied = op12.judge(pages, weights, rules=[("allow", "a.fr/"), ("block", "a.fr/")]).first()
    assert (tied["rule"], tied["verdict"]) == ("a.fr/", "block")


# ------------------------------------------------------------------ 13


def runs_by_hand(ws):
    """Every period in turn: maximal stretches of words q apart that agree; the smallest period of a stretch counts."""
    found = {}
    for q in range(1, len(ws) // 3 + 1):
        i = 0
        while i + q < len(ws):
            s = i
            while i + q < len(ws) and ws[i] == ws[i + q]:
                i += 1
            if i > s and i - s + q >= max(24, 3 * q):
                found.setdefault((s, i - s + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    ws = []
    for _ in range(rng.randint(0, 6)):
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 22))]
        ws += unit * rng.randint(1, 7) + [rng.choice("abcde")] * rng.randint(0, 4)
    return ws


def test_runs_equal_brute_force():
    rng = random.Random(13)
    texts = [random_words(rng) for _ in range(400)] + [[], ["a"], ["a"] * 23, ["a"] * 24, ["a", "b"] * 12, list("abcdefgh") * 3]
    assert op13.runs_of_texts(texts) == [runs_by_hand(t) for t in texts]
    assert sum(map(len, op13.runs_of_texts(texts))) > 200


def test_runs_do_not_span_texts():
    assert op13.runs_of_texts([["a"] * 12, ["a"] * 12, ["a"] * 30]) == [[], [], [(0, 30, 1)]]


def test_positions_keep_order():
    rng = random.Random(5)
    values = rng.sample(range(100_000), 5000)
    kept = op13.Positions(values[0])
    held = [values[0]]
    for v in values[1:]:
        below, above = kept.add(v)
        assert below == max((x for x in held if x < v), default=-1) if len(held) % 97 == 0 else True
        assert above == min((x for x in held if x > v), default=-1) if len(held) % 97 == 0 else True
        held.append(v)
    assert list(kept) == sorted(values) and kept.size == len(values)


@pytest.mark.parametrize("n", [200_000])
def test_long_periodic_texts(n):
    assert op13.runs_of_texts([["x"] * n]) == [[(0, n, 1)]]
    assert op13.runs_of_texts([list("abc") * (n // 3) + ["d"]]) == [[(0, n // 3 * 3, 3)]]


def test_run_rows(spark):
    body = "start " + "One two THREE\t" * 10 + "\x0bend"
    rows = [(1, body), (2, None), (3, " \n "), (None, "x " * 40), (4, "é " * 30 + "e"), (4, "é " * 30 + "e"), (5, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_runs", F.lit("clash"))
    got = op13.periodic_runs(df).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert (by[1]["n_runs"], by[1]["start"], by[1]["length"], by[1]["period"], by[1]["exponent_milli"]) == (1, 1, 30, 3, 10000)
    assert by[1]["runs_sha256"] == sha("1,30,3\n") and by[1]["collapsed_sha256"] == sha("start One two THREE end")
    for k in (2, 3):
        assert tuple(by[k])[1:] == (0, None, None, None, None, sha(""), sha(""))
    assert (by[None]["length"], by[None]["collapsed_sha256"]) == (40, sha("x"))
    assert (by[4]["length"], by[4]["collapsed_sha256"]) == (30, sha("é e"))
    assert by[5]["collapsed_sha256"] == sha("a b")
    assert op13.periodic_runs(df.limit(0)).collect() == []


def test_ties_of_the_greatest_exponent():
    ws = ["a"] * 24 + ["z"] + ["b"] * 24
    assert op13.judge(1, ws, op13.runs_of_texts([ws])[0])["start"] == 0


def test_planted_tails():
    hit = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    ws = [f"w{i}" for i in range(100)]
    g = zlib.crc32(str(hit).encode()) // 10
    a = g % 100
    p = 1 + (100 - a) // (3 + g % 8)
    assert op13.planted(hit, ws) == [ws[i] if i < a else ws[a + (i - a) % p] for i in range(100)]
    assert op13.planted(None, ws) == ws and op13.planted(hit, []) == []
