"""Exact dedup, SimHash near-dedup and line dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from samples import EXTRA, ROWS, documents, union_find

from shroud.llm import catalog, line_dedup, simhash
from shroud.llm.common import connected_components, release
from shroud.llm.exact_dedup import dedup_groups, exact_dedup
from shroud.llm.line_dedup import dedup_lines, line_decisions
from shroud.llm.simhash import near_dedup, simhash_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# exact dedup ----------------------------------------------------------------
def brute_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[(t or "").translate(LOWER)] if x is not None]
        out.append((i, max(ids, default=None), len(groups[(t or "").translate(LOWER)]),
                    hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 3, 70])
def test_exact_groups(spark, partitions):
    rows = ROWS + [(100 + i, random.Random(i).choice(["Aa", "aA", "é", "É", "b"])) for i in range(300)]
    got = dedup_groups(documents(spark, rows).repartition(partitions)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute_groups(rows)
    kept = {}
    for r in got:
        kept.setdefault(r.text_sha256, []).append(r.kept)
        assert not r.kept or r.doc_id == r.keep_id
    assert all(sum(k) == 1 for k in kept.values())


def test_exact_smallest_and_empty(spark):
    got = {r.keep_id for r in dedup_groups(documents(spark), keep="smallest").collect()
           if r.text_sha256 == hashlib.sha256(b"tie").hexdigest()}
    assert got == {8}
    assert dedup_groups(documents(spark, [])).count() == 0
    assert exact_dedup(documents(spark, [])).count() == 0


def test_exact_dedup_keeps_rows_whole(spark):
    docs = documents(spark)
    out = exact_dedup(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted([1, 3, 4, 5, 6, 7, 10], key=str)
    assert all(r[n] == f"x{j}" for r in rows for j, n in enumerate(EXTRA))


# SimHash --------------------------------------------------------------------
def brute_fingerprint(text):
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in (text or "").translate(LOWER)).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    links = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    root = union_find(len(fps), links)
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, f"{f:016x}", least.get(r)) for (i, _), f, r in zip(rows, fps, root, strict=True)), key=str)


def near_copies(seed, copies, words=400):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(words)] = f"x{rng.randrange(9999)}"
        out.append(" ".join(text))
    return out


def sample_rows(spark, n=200):
    got = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(n).collect()
    return [(r.doc_id, r.text) for r in got]


def test_simhash_is_brute_force(spark):
    rows = ROWS + [(1000 + i, t) for i, t in enumerate(near_copies(1, 60) + near_copies(2, 40, 90))]
    rows += [(2000 + i, t) for i, t in sample_rows(spark)]
    got = simhash_groups(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == brute_components(rows)


def test_every_near_pair_shares_a_key():
    rng = random.Random(5)
    for m in (6, 7, 8, 9):
        patterns, segments = simhash.chain_patterns(m, 4), simhash.segments_of(m)
        for _ in range(400):
            diff = sum(1 << b for b in rng.sample(range(64), 4))
            empty = {i for i, (a, w) in enumerate(segments) if not diff >> a & ((1 << w) - 1)}
            assert any(empty.issuperset(p) for p in patterns)
            assert simhash._near(np.array([diff], np.uint64), np.array([0], np.uint64), m, 4).tolist() == [0]
        diff = sum(1 << b for b in rng.sample(range(64), 5))
        assert not len(simhash._near(np.array([diff], np.uint64), np.array([0], np.uint64), m, 4))


def linked_groups(fps, links):
    at = {f: i for i, f in enumerate(fps)}
    root = union_find(len(fps), [(at[a], at[b]) for a, b in links])
    return sorted(sorted(f for f, r in zip(fps, root, strict=True) if r == x) for x in set(root))


@pytest.mark.parametrize("bucket_rows", [3, 32_768])
def test_crowded_buckets_give_the_same_components(spark, bucket_rows):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(3)]
    fps = set()
    for b in base:
        for _ in range(60):
            x = b
            for bit in rng.sample(range(64), rng.randrange(5)):
                x ^= 1 << bit
            fps.add(x - (1 << 64) if x >> 63 else x)
    fps = sorted(fps)
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp bigint"), 4, bucket_rows)
    got = [(r.a, r.b) for r in links.collect()]
    unsigned = [f % (1 << 64) for f in fps]
    want = [(fps[a], fps[b]) for a in range(len(fps)) for b in range(a)
            if (unsigned[a] ^ unsigned[b]).bit_count() <= 4]
    assert linked_groups(fps, got) == linked_groups(fps, want)


def test_near_dedup_keeps_one_of_each(spark):
    rows = ROWS + [(1000 + i, t) for i, t in enumerate(near_copies(1, 30))]
    out = near_dedup(documents(spark, rows))
    assert out.columns == documents(spark, rows).columns
    want = sorted({c for _, _, c in brute_components(rows) if c is not None})
    assert sorted(r.doc_id for r in out.collect()) == want
    assert near_dedup(documents(spark, [])).count() == 0
    assert simhash_groups(documents(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(40)]
    links += [(500, 501 + i) for i in range(50)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a int, b int")).collect()}
    root = union_find(600, links)
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root[x] for x in touched}


# lines ----------------------------------------------------------------------
def shingle_set(line):
    return {line[i:i + 8] for i in range(len(line) - 7)}


def brute_lines(rows):
    """Dropped line numbers of each row."""
    places, lines = [], []
    for at, (_, text) in enumerate(rows):
        for pos, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                places.append((at, pos))
                lines.append(line)
    sets = [shingle_set(x) for x in lines]
    links = []
    for a in range(len(lines)):
        for b in range(a):
            if lines[a] == lines[b]:
                links.append((a, b))
            elif sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])):
                common = len(sets[a] & sets[b])
                if common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                    links.append((a, b))
    root = union_find(len(lines), links)
    dropped = [[] for _ in rows]
    for i, (at, pos) in enumerate(places):
        if root[i] != i:
            dropped[at].append(pos)
    return dropped


def line_rows(seed=4):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    bases = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (12, 20, 30, 45, 80) for _ in range(6)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            words = rng.choice(bases).split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            lines.append(" ".join(words))
        rows.append((i, "\n".join([*lines, rng.choice(["", " ", "short", "Of."])])))
    return rows


def test_line_decisions_are_brute_force(spark):
    rows = line_rows() + [(100, None), (101, ""), (102, "a\n\na\nshort"), (103, "日本語のテキスト、長い文です。" * 12),
                          (104, "日本語のテキスト、長い文です。" * 12 + "終"), (103, "a\n\na")]
    got = line_decisions(documents(spark, rows).coalesce(1)).collect()
    want = brute_lines(rows)
    assert [(r.doc_id, r.n_lines) for r in got if r.doc_id != 103] and len(got) == len(rows)
    found = sorted((r.doc_id, r.n_lines, tuple(r.dropped)) for r in got)
    expected = sorted((i, len((t or "").split("\n")), tuple(d)) for (i, t), d in zip(rows, want, strict=True))
    total = sum(len(d) for d in want)
    wrong = sum(len(set(a[2]) ^ set(b[2])) for a, b in zip(found, expected, strict=True))
    assert [f[:2] for f in found] == [e[:2] for e in expected]
    assert wrong <= 0.02 * total, (wrong, total)  # banding may miss a pair near the threshold


def dropped_lines(spark, rows):
    got = line_decisions(documents(spark, rows).coalesce(1)).collect()
    return [list(d) for _, d in sorted((r.doc_id, r.dropped) for r in got)]


def test_every_shingle_of_a_long_line_counts(spark):
    rng = random.Random(21)
    rows = []
    for alphabet in ("日本語文字列長短高低東西南北", "abcdefghijklmnopqrstuvwxyz0123456789+/"):
        for _ in range(8):
            body = "".join(rng.choice(alphabet) for _ in range(2000))
            for _ in range(2):
                lead = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(18))
                rows.append((len(rows), f"{lead} {body}"))
    want = brute_lines(rows)
    assert sum(map(len, want)) == 16 and dropped_lines(spark, rows) == want


@pytest.mark.parametrize("bucket_lines", [2, 1_000_000])
def test_families_under_a_frequent_template_line(spark, monkeypatch, bucket_lines):
    monkeypatch.setattr(line_dedup, "BUCKET_LINES", bucket_lines, raising=False)
    rng = random.Random(22)

    def text(n):
        return "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))

    shared = text(90)
    rows = [(0, "\n".join([shared + text(20)] * 50))]
    for _ in range(300):
        own = text(45)
        for end in ("one", "two"):
            rows.append((len(rows), shared + own + end))
    want = brute_lines(rows)
    assert sum(map(len, want)) == 49 + 300 and dropped_lines(spark, rows) == want


def test_lines_of_one_template_do_not_meet(spark):
    rng = random.Random(23)
    shared = "".join(rng.choice("abcdefghijklmnop ") for _ in range(90))
    met = []
    for n in (200, 400, 800):
        lines = [(f"{i:05d}", f"{i:05d}", 0, shared + "".join(rng.choice("abcdefghijklmnop ") for _ in range(45)))
                 for i in range(n)]
        table = spark.createDataFrame(lines, "node string, root string, n int, line string")
        table = table.withColumn("n", line_dedup.F.size(line_dedup._shingles("line")))
        pairs, _ = line_dedup._by_prefix(table, 0.8)
        met.append(pairs.count())
    assert met[2] <= 8, met


def test_sketches_are_the_lowest_shingles(spark):
    rng = random.Random(24)

    def text(n, alphabet="abcdefghijklmnop 日本語𝄞é"):
        return "".join(rng.choice(alphabet) for _ in range(n))

    lines = [text(n) for n in (8, 9, 10, 25, 43, 44, 200, 3000)] + [text(30) * 40, "a" * 500, "ab" * 300, text(12) * 50]
    numbered = documents(spark, [(0, "\n".join([*lines, "short", "", *lines]))]).selectExpr("0L AS row", "doc_id", "text")
    found, _ = line_dedup._distinct(numbered)
    got = {r.h1: sorted(r.bands) for r in found.collect()}
    assert len(got) == len(lines)
    for line in lines:
        low = sorted(int(np.int64(np.uint64(xxhash.xxh64(s.encode("utf-32-be"), seed=42).intdigest())))
                     for s in {line[i:i + 8] for i in range(len(line) - 7)})[:line_dedup.SKETCH]
        at = [low] if len(low) < 3 else [low[i:i + 3] for i in range(len(low) - 2)]
        want = []
        for band in at:
            h = 42
            for x in band:
                h = xxhash.xxh64(int(x).to_bytes(8, "little", signed=True), seed=h).intdigest()
            want.append(int(np.int64(np.uint64(h))))
        h1 = int(np.int64(np.uint64(xxhash.xxh64(line.encode(), seed=42).intdigest())))
        assert got[h1] == sorted(want), line


def test_no_pair_of_lines_is_compared_twice(spark, monkeypatch):
    rng = random.Random(25)
    compared = []
    alike = line_dedup._alike

    def noted(pairs, texts, similarity):
        compared.append([tuple(sorted((r.a, r.b))) for r in pairs.select("a", "b").collect()])
        return alike(pairs, texts, similarity)

    monkeypatch.setattr(line_dedup, "_alike", noted)
    shared = "".join(rng.choice("abcdefghijklmnop ") for _ in range(90))
    rows = [(i, shared + "".join(rng.choice("abcdefghijklmnop ") for _ in range(45))) for i in range(12)]
    want = brute_lines(rows)
    assert dropped_lines(spark, rows) == want and len(compared) == 2
    pairs = [p for round_ in compared for p in round_]
    assert compared[0] and len(pairs) == len(set(pairs))


@pytest.mark.parametrize("rows", [1, 2**12])
def test_only_wanted_lines_are_shuffled(spark, monkeypatch, rows):
    monkeypatch.setattr(line_dedup, "FEWEST_ROWS", rows)
    monkeypatch.setattr(line_dedup, "MOST_ROWS", rows)
    lines = spark.range(20_000).selectExpr("concat('a line of some length ', id) AS line", "id").selectExpr(
        "line", "id", "xxhash64(line) AS h1")
    got = {r.id for r in line_dedup._likely(lines, lines.filter("id % 100 = 0"), "h1").collect()}
    # 200 of 512 bits let less than 0.4 of the others through
    assert set(range(0, 20_000, 100)) <= got and len(got) < (8_000 if rows == 1 else 230)


def test_bands_and_texts_are_not_kept_together(spark, monkeypatch):
    """Results with blocks of pairs and shingles of equal rank, and the tables that lie on disk at each write."""
    rng = random.Random(26)
    kept, write, drop = {}, line_dedup.write_stage, line_dedup.drop_stage
    together = []

    def noted(df, name, *args, **named):
        together.append({*kept.values(), name})
        table, path = write(df, name, *args, **named)
        kept[path] = name
        return table, path

    def dropped(session, path):
        kept.pop(path, None)
        drop(session, path)

    monkeypatch.setattr(line_dedup, "write_stage", noted)
    monkeypatch.setattr(line_dedup, "drop_stage", dropped)
    for name, value in (("BUCKET_LINES", 2), ("FREQUENT_SHINGLES", 40), ("TASK_SHINGLES", 500), ("MOST_ROWS", 1),
                        ("FEWEST_ROWS", 1)):
        monkeypatch.setattr(line_dedup, name, value, raising=False)

    def text(n):
        return "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))

    shared = text(60)
    rows = [(i, shared + text(14)) for i in range(40)]
    rows += [(100 + i, t[:70] + text(4)) for i, (_, t) in enumerate(rows[:30])]
    want = brute_lines(rows)
    assert sum(map(len, want)) > 20 and dropped_lines(spark, rows) == want
    assert not any({"line-distinct", "line-texts"} <= names for names in together), together
    assert {"line-prefixes", "line-links"} <= set().union(*together)


def test_lines_taken_out(spark):
    rows = [(1, "first line of some text\nsecond"), (2, "second\n\nthird"), (3, None), (3, None), (4, "third\nsecond")]
    docs = documents(spark, rows).coalesce(1)
    out = dedup_lines(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [
        (1, "first line of some text\nsecond"), (2, "\nthird"), (3, ""), (3, ""), (4, "")]
    assert dedup_lines(documents(spark, [])).count() == 0
    assert line_decisions(documents(spark, [])).count() == 0
    assert line_decisions(documents(spark)).count() == len(ROWS)


def test_queries_on_the_small_tables(spark):
    rows = sample_rows(spark)
    got = catalog.op4_simhash(spark, "/root/testdata/sf0.001").collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == brute_components(rows)
    got = catalog.op5_exact_dedup(spark, "/root/testdata/sf0.001").collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute_groups(rows)
    rows = sorted(rows)
    want = {i: d for (i, _), d in zip(rows, brute_lines(rows), strict=True)}
    got = {r.doc_id: list(r.dropped) for r in catalog.op9_line_dedup(spark, "/root/testdata/sf0.001").collect()}
    total, wrong = sum(map(len, want.values())), sum(len(set(want[i]) ^ set(got[i])) for i in want)
    assert got.keys() == want.keys() and wrong <= 0.02 * total


def test_stage_tables_can_be_released(spark):
    dedup_groups(documents(spark)).count()
    assert release(spark) > 0 and release(spark) == 0
