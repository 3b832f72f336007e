"""Merkle manifest, URL filter and periodic runs against brute force."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from samples import documents, ident

from shroud.llm import catalog
from shroud.llm import merkle as M
from shroud.llm import periodic_runs as R
from shroud.llm import url_filter as U

SF = "/root/testdata/sf0.001"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Merkle manifest -------------------------------------------------------------
def _tree(leaves):
    """(top, per leaf the (left, right) siblings of each level)."""
    proofs = [[] for _ in leaves]
    level = [(leaf, [i]) for i, leaf in enumerate(leaves)]
    while len(level) > 1:
        merged = []
        for a in range(0, len(level), 3):
            run = level[a:a + 3]
            for j, (_, own) in enumerate(run):
                for i in own:
                    proofs[i].append(("".join(h for h, _ in run[:j]), "".join(h for h, _ in run[j + 1:])))
            merged.append((_sha("".join(h for h, _ in run)), [i for _, own in run for i in own]))
        level = merged
    return level[0][0], proofs


def _manifest(rows):
    def leaf(r, text):
        return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                            for v in (r[0], r[3], r[2], r[4], text)))

    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r, leaf(r, r[1])))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        groups[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees.append(_tree([h for _, h in groups[s]]))
    root, upper = _tree([top for top, _ in trees])
    out = []
    for s, (top, proofs), above in zip(order, trees, upper):
        for (r, h), proof in zip(groups[s], proofs):
            shown = h
            if r[1] is not None and zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 2 == 0:
                shown = leaf(r, r[1].replace("\n", ""))
            for a, b in proof + above:
                shown = _sha(a + shown + b)
            out.append((r[0], h, top, root, _sha("".join(a + b for a, b in proof + above)), shown, shown == root))
    return out


@pytest.mark.parametrize("sources", ["CASE WHEN doc_id % 3 = 0 THEN 'a' WHEN doc_id % 3 = 1 THEN 'É' END",
                                     "'one'", "CAST(NULL AS STRING)", "CAST(doc_id % 5 AS STRING)"])
def test_manifest_edge_rows(spark, sources):
    docs = documents(spark).withColumn("source", F.expr(sources))
    got = M.tamper_check(docs).collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert sorted(map(ident, got)) == sorted(map(ident, _manifest(rows)))
    assert any(not r.verified for r in got) and any(r.verified for r in got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 82])
def test_manifest_sizes_and_hot_group(spark, n):
    docs = spark.range(n + 4).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t\n"), F.col("id") % 7).alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") >= n, F.col("id").cast("string")).otherwise("hot").alias("source"),
        F.lit(3).cast("bigint").alias("n_chars")).repartition(5)
    got = M.tamper_check(docs).collect()
    assert sorted(map(ident, got)) == sorted(map(ident, _manifest([tuple(r) for r in docs.collect()])))


def test_manifest_proofs_are_real(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("leaf", M.leaf_hash([F.col("doc_id"), F.col("text")]))
    out = M.merkle_manifest(docs, "doc_id", "source", "leaf")
    folded = out.select(M.fold(F.col("leaf"), "proof").alias("f"), M.as_hex(F.col("root")).alias("r"),
                        M.fold(F.unhex(F.sha2(F.lit("x").cast("binary"), 256)), "proof").alias("wrong"))
    assert folded.filter("f = r AND wrong <> r").count() == docs.count() == out.count()
    assert M.tamper_check(docs.limit(0)).collect() == []


# URL filter --------------------------------------------------------------------
def _judge(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min((path.index(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(rule), verdict, rule) for verdict, rule in rules for h, _, p in [rule.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, max(fits)[2] if fits else None, max(fits)[1] if fits else None


def test_list_rules_on_all_pages(spark):
    got = catalog.op12_url_filter(spark, "/root/testdata/sf0.01").collect()
    urls = {r.page_id: r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = _judge(urls[r.page_id], catalog.URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


URLS = [(1, None), (2, ""), (3, "no scheme.com/en/"), (4, "http://COM/x"), (5, "https://a.b.com"), (5, "https://a.b.com"),
        (6, "x://WWW.example.com/en/?q=://z"), (7, "http://example.com/en"), (8, "http://notexample.com/en/1#/a"),
        (9, "http://éÉ.net/es/\n"), (10, "http://a.net?b=/es/"), (None, "http://u.net/fr/"), (11, "http://" + "s." * 3000 + "com/")]


def test_list_rules_edge_urls(spark):
    pages = spark.createDataFrame([(i, u, "h", "r", "v") for i, u in URLS],
                                  "page_id bigint, url string, host string, rule string, verdict string")
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = U.filter_urls(pages, empty, catalog.URL_RULES).collect()
    want = [(i, *_judge(u, catalog.URL_RULES)) for i, u in URLS]
    assert sorted(map(ident, [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got])) == sorted(
        map(ident, [(i, h, p, rule, v or "allow") for i, h, p, rule, v in want]))
    assert U.filter_urls(pages.limit(0), empty, catalog.URL_RULES).collect() == []


def _mined(baskets, min_urls, confidence, lift):
    """Association rules by counting every subset of up to MAX_TOKENS tokens."""
    from itertools import combinations

    n, seen = len(baskets), {}
    share = {v: sum(label == v for _, label in baskets) / n for v in ("allow", "block")}
    for tokens, label in baskets:
        for k in range(1, U.MAX_TOKENS + 1):
            for part in combinations(sorted(tokens), k):
                seen.setdefault(part, {"allow": 0, "block": 0})[label] += 1
    rules = {}
    for part, counts in seen.items():
        for verdict, hits in counts.items():
            total = sum(counts.values())
            if hits >= min_urls and hits / total >= confidence and hits / total / share[verdict] >= lift:
                rules[part, verdict] = (hits / total, hits / n)
    return {key: found for key, found in rules.items()
            if not any((part, key[1]) in rules and rules[part, key[1]][0] >= found[0]
                       for k in range(1, len(key[0])) for part in combinations(key[0], k))}


def test_rules_are_mined_from_all_tokens_of_long_urls(spark):
    rng = random.Random(7)
    baskets = []
    for _ in range(120):
        spam, pair = rng.random() < 0.4, rng.random() < 0.5
        tail = ["path:win", "query:now"] if spam else rng.choice([["path:win"], ["query:now"], []])
        baskets.append(([f"host:h{j:02}" for j in range(14)] + ["path:p", "path:q"] * pair + ["path:read"]
                        + rng.sample(["query:a", "query:b", "query:c"], 2) + tail, "block" if spam else "allow"))
    want = _mined(baskets, U.MIN_URLS, U.MIN_CONFIDENCE, U.MIN_LIFT)
    assert (("path:win", "query:now"), "block") in want
    rules = U.mine_rules(spark.createDataFrame(baskets, "tokens array<string>, label string")).collect()
    assert {(tuple(r.tokens), r.verdict): (round(r.confidence, 9), round(r.support, 9)) for r in rules} == {
        k: (round(c, 9), round(s, 9)) for k, (c, s) in want.items()}
    assert len(rules) == len(want) and all(r.anchor in r.tokens for r in rules)
    # 300 words that always come together are one to FP-growth, and each has its rule
    words = [f"path:w{j:03}" for j in range(300)]
    pages = [(words + ["query:x"], "block")] * 20 + [(["host:h", "query:x"], "allow")] * 40
    rules = U.mine_rules(spark.createDataFrame(pages, "tokens array<string>, label string")).collect()
    assert {(tuple(r.tokens), r.verdict) for r in rules} == {((w,), "block") for w in words} | {(("host:h",), "allow")}


def test_mined_rules_equal_brute_force_and_decide(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        spam = rng.random() < 0.3
        host = rng.choice(["win", "pills"]) if spam else rng.choice(["news", "blog", "pills"])
        word = rng.choice(["bet", "buy"]) if spam else rng.choice(["bet", "read", "talk"])
        rows.append((i, f"http://{host}.x{rng.randint(0, 2)}.org/{word}/{rng.randint(0, 99)}?q={rng.randint(0, 3)}"))
        if i % 2 == 0:
            labels.append((i, 0 if spam and i % 4 else 1, 1 if spam else 0))
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    marked = spark.createDataFrame(labels + labels[:5], "doc_id bigint, quality int, toxic int")
    tokens = {r.page_id: r.t for r in pages.select("page_id", U.tokens_of(F.col("url")).alias("t")).collect()}
    assert sorted(tokens[0]) == sorted(set(tokens[0]))
    baskets = [(tokens[i], "block" if q == 0 or t == 1 else "allow") for i, q, t in labels]
    want = _mined(baskets, U.MIN_URLS, U.MIN_CONFIDENCE, U.MIN_LIFT)
    rules = U.mine_rules(spark.createDataFrame(baskets, "tokens array<string>, label string")).collect()
    assert {(tuple(r.tokens), r.verdict): (round(r.confidence, 9), round(r.support, 9)) for r in rules} == {
        k: (round(c, 9), round(s, 9)) for k, (c, s) in want.items()}
    assert any(v == "block" for _, v in want) and any(len(t) > 1 for t, _ in want)
    for r in U.filter_urls(pages, marked, [("block", "x1.org/talk/")]).collect():
        fits = sorted(((c, s, len(t), t, v) for (t, v), (c, s) in want.items() if set(t) <= set(tokens[r.page_id])),
                      reverse=True)
        if r.rule:
            assert r.verdict == "block" and "/talk/" in r.path and r.method_rule is None
        elif fits:
            assert (r.verdict, r.method_rule) == (fits[0][4], " ".join(fits[0][3]))
        else:
            assert (r.verdict, r.method_rule) == ("allow", None)


# Periodic runs -------------------------------------------------------------------
def _runs(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j + 1 < len(words) and words[j + 1] == words[j + 1 - q]:
                j += 1
            if j - i + 1 + q >= max(12, 2 * q):
                found.setdefault((i - q, j - i + 1 + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def _collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 4)):
            letters, words = "abcdefgh"[:rng.choice([1, 2, 2, 3, 5])], []
            for _ in range(rng.randint(0, 8)):
                base = [rng.choice(letters) for _ in range(rng.randint(1, 30))]
                words += (base * rng.randint(1, 6))[:rng.randint(1, 120)]
                if rng.random() < 0.3 and words:
                    words += words[-rng.randint(1, len(words)):]
            texts.append(" ".join(words[:400]).encode())
        for text, (n, runs, collapsed) in zip(texts, R.runs_of(texts), strict=True):
            words = text.split()
            assert n == len(words) and runs == _runs(words) and collapsed == _collapsed(words, runs)


def test_long_texts_of_one_short_period():
    for text, count in ((b"a " * 300_000, 1), ((b"a " * 50 + b"b ") * 4_000, 4_001)):
        (n, runs, collapsed), = R.runs_of([text])
        assert len(runs) == count and n == len(text) // 2 and len(collapsed) <= 3


def _planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def _digest(doc_id, text):
    words = _planted(doc_id, text)
    runs = _runs(words)
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    one = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    return (doc_id, len(runs), *one, _sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            hashlib.sha256(_collapsed(words, runs)).hexdigest())


def test_run_query_on_whole_documents(spark):
    got = catalog.op13_periodic_runs(spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    short = {r.doc_id for r in rows if len((r.text or "").split()) < 3000}
    assert sorted(ident(g) for g in got if g.doc_id in short) == sorted(ident(_digest(*r)) for r in rows if r.doc_id in short)
    assert sum(g.n_runs > 0 for g in got) > len(rows) // 20


def test_run_edge_rows(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    small = [i for i, (_, t) in enumerate(rows) if len((t or "").split()) < 2000]
    got = sorted(map(ident, R.run_digest(docs.select("*", R.with_planted_repeat(docs).alias("planted")), text_col="planted").collect()))
    assert len(got) == len(rows)
    want = sorted(ident(_digest(*rows[i])) for i in small)
    assert [g for g in got if g in want] == want
    runs = R.periodic_runs(docs.filter("doc_id = 4")).first()
    assert [tuple(r) for r in runs.runs] == [(0, 20000, 5)] and runs.collapsed == "lorem Ipsum dolor sit amet end"
    assert R.run_digest(docs.limit(0)).collect() == []
