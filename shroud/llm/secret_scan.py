"""Secret scan: fixed patterns plus a battery of randomness tests (DataFrame functions only).

Fixed patterns (base spans, always reported): credentials assigned to a
telling name, access keys, long hexadecimal runs.  Matches are found leftmost
and without overlap for each kind, and then dropped if too short.

Added spans (kind ``random``): other runs of at least ``TOKEN_CHARS`` letters,
digits and ``+/_-`` whose encoding can be inferred (hexadecimal, base 32, base
36, base 62, base 64; all need digits and letters).  The null hypothesis is
that a run is uniformly random in its alphabet.  Three tests question it:
chi-squared for uniform symbols, runs above and below the alphabet's middle,
and the serial correlation of neighbouring symbols; the smallest p-value times
three is the run's.  Short runs carry little evidence and long ones much, so
p-values are only compared within strata of encoding and length (by powers of
two): the Benjamini-Hochberg rule rejects randomness in a stratum so that at
most ``FDR`` of the rejected (ordinary) runs are really random ones, that is
missed secrets.  Runs that aren't rejected are reported unless they overlap a
base span.  A run with separators (a path, say, or a flag with a token) is also
cut at ``+/``, at ``_-`` and at all four, and its parts of ``TOKEN_CHARS`` and
more are tested like runs; reported spans that overlap are joined to one.  The rule needs ranks over all texts; they come from a histogram of
p-values (at most ``BINS`` counts for each stratum), never from a sort.

Spans are code points, end exclusive.  Texts are read once: matches and the
gaps between them are written to a stage table, and everything later works on
matches.  Windows run within one text.  NULL and empty texts have no spans;
repeated rows give repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shroud.llm.common import whole_text, write_stage

TOKEN_CHARS = 20
FDR = 0.01
BINS = 1024
_BINS_PER_BIT = 16
# The base patterns and least lengths, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
PATTERNS = (ASSIGN, "AKIA[A-Z0-9]+", "[0-9a-f]+", f"[A-Za-z0-9+/_-]{{{TOKEN_CHARS},}}")
# Shorter matches of the hexadecimal pattern are nearly every letter a-f of a
# text; asking for the least length at once finds the same runs.
_SEARCH = (ASSIGN, "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}", PATTERNS[3])
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Encodings in the order in which they are tried: name, whole-run pattern, alphabet.
ENCODINGS = (
    ("hex", "[0-9a-f]+|[0-9A-F]+", _DIGITS + "abcdef"),
    ("base32", "[A-Z2-7]+", _UPPER + "234567"),
    ("base36", "[a-z0-9]+|[A-Z0-9]+", _DIGITS + _LOWER),
    ("base62", "[A-Za-z0-9]+", _DIGITS + _UPPER + _LOWER),
    ("base64", "[A-Za-z0-9+/]+", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "[A-Za-z0-9_-]+", _UPPER + _LOWER + _DIGITS + "-_"),
)
_FOLDED = ("hex", "base36")  # either case, compared in lower case


def _matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, found): for each kind with matches, these and the lengths of the gaps around them."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       whole_text(text_col).alias("text"))
    found = [F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in _SEARCH]
    rows = rows.select("*", *[f.alias(k) for f, k in zip(found, KINDS, strict=True)])
    parts = [
        F.when(F.size(k) > 0, F.struct(
            F.lit(i).alias("kind"), F.col(k).alias("match"),
            F.transform(F.split("text", p, -1), lambda x: F.length(x)).alias("gap")))
        for i, (k, p) in enumerate(zip(KINDS, _SEARCH, strict=True))
    ]
    out, _ = write_stage(rows.select("doc_id", "row", F.array_compact(F.array(*parts)).alias("found")), "secrets")
    return out


def _spans(found: DataFrame) -> DataFrame:
    """(row, kind, match, start, end) of the matches that are long enough."""
    part = found.select("row", F.explode("found").alias("f"))
    each = part.select("row", "f.kind", F.posexplode(F.arrays_zip("f.match", "f.gap")).alias("at", "z"))
    each = each.filter("z.match IS NOT NULL").select(
        "row", "kind", "at", F.col("z.match").alias("match"), F.col("z.gap").alias("gap"))
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(so_far))
    each = each.withColumn("start", F.col("end") - F.length("match"))
    long_enough = (
        ((F.col("kind") == 0) & (F.length(F.regexp_extract("match", ASSIGN, 2)) >= 8))
        | ((F.col("kind") == 1) & (F.length("match") >= 16))
        | ((F.col("kind") == 2) & (F.length("match") >= 32))
        | (F.col("kind") == 3))
    return each.filter(long_enough).select("row", "kind", "match", "start", "end")


def _encoding(token: Column) -> Column:
    """The name of the inferred encoding, NULL for ordinary words and numbers."""
    out = F.lit(None).cast("string")
    mixed = token.rlike("[0-9]") & token.rlike("[A-Za-z]")
    for name, pattern, _ in reversed(ENCODINGS):
        both = token.rlike("[a-z]") & token.rlike("[A-Z]") if name.startswith("base6") else F.lit(True)
        out = F.when(both & token.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return F.when(mixed, out)


def _with_parts(runs: DataFrame) -> DataFrame:
    """``runs(row, kind, start, end, token)`` and their parts between separators that are long enough."""
    pieces = F.array(*[F.struct(F.lit(i).alias("cut"), F.split("token", p, -1).alias("pieces"))
                       for i, p in enumerate(("[+/]", "[_-]", "[+/_-]"))])
    each = runs.filter(F.col("token").rlike("[+/_-]")).select(
        "row", "kind", F.col("start").alias("run"), F.length("token").alias("length"), F.explode(pieces).alias("p"))
    each = each.select("row", "kind", "run", "length", "p.cut", F.posexplode("p.pieces").alias("at", "token"))
    so_far = Window.partitionBy("row", "run", "cut").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.col("run") + F.sum(F.length("token") + 1).over(so_far) - 1)
    size = F.length("token")
    parts = each.filter((size >= TOKEN_CHARS) & (size < F.col("length"))).select(
        "row", "kind", (F.col("end") - size).alias("start"), "end", "token")
    return runs.unionByName(parts.distinct())


def _joined(spans: DataFrame) -> DataFrame:
    """``spans(row, kind, start, end)`` of one kind, those that overlap as one."""
    ordered = Window.partitionBy("row").orderBy("start", "end")
    reached = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    fresh = spans.select("*", F.coalesce(F.col("start") >= reached, F.lit(True)).cast("int").alias("fresh"))
    numbered = fresh.select("*", F.sum("fresh").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("number"))
    return numbered.groupBy("row", "number").agg(
        F.first("kind").alias("kind"), F.min("start").alias("start"), F.max("end").alias("end")).drop("number")


def _two_sided(z: Column) -> Column:
    """P(|Z| >= |z|) for a standard normal Z (rational approximation 26.2.17 of the handbook
    by Abramowitz and Stegun; fixed values)."""
    t = 1.0 / (1.0 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.least(F.lit(1.0), 2.0 * 0.3989422804014327 * F.exp(-z * z / 2.0) * poly)


def randomness(tokens: DataFrame) -> DataFrame:
    """``tokens(token, encoding)`` with ``n`` symbols and ``p`` of the randomness tests."""
    alphabet, size = F.lit(None).cast("string"), F.lit(None).cast("double")
    for name, _, letters in ENCODINGS:
        alphabet = F.when(F.col("encoding") == name, F.lit(letters)).otherwise(alphabet)
        size = F.when(F.col("encoding") == name, F.lit(float(len(letters)))).otherwise(size)
    folded = F.when(F.col("encoding").isin(*_FOLDED), F.lower("token")).otherwise(F.col("token"))
    rows = tokens.select("*", folded.alias("body"), alphabet.alias("alphabet"), size.alias("k"),
                         F.length("token").cast("double").alias("n"))
    symbols = F.split("alphabet", "")
    squares = F.aggregate(
        F.filter(symbols, lambda c: c != ""), F.lit(0.0),
        lambda s, c: s + F.pow((F.length("body") - F.length(F.replace("body", c, F.lit("")))).cast("double"), 2.0))
    binary = F.lit(None).cast("string")  # each symbol: 0 in the lower half of the alphabet, else 1
    for name, _, letters in ENCODINGS:
        binary = F.when(F.col("encoding") == name, F.translate(
            "body", letters, "0" * (len(letters) // 2) + "1" * (len(letters) - len(letters) // 2))).otherwise(binary)
    codes = F.transform(F.filter(F.split("body", ""), lambda c: c != ""),
                        lambda c: F.position(c, F.col("alphabet")).cast("double") - 1.0)
    rows = rows.select("*", squares.alias("squares"), binary.alias("sides"), codes.alias("codes"))
    zeros = F.length(F.replace("sides", F.lit("1"), F.lit(""))).cast("double")
    changes = ((F.length("sides") - F.length(F.replace("sides", F.lit("01"), F.lit(""))))
               + (F.length("sides") - F.length(F.replace("sides", F.lit("10"), F.lit(""))))) / 2
    middle = (F.col("k") - 1) / 2
    later = F.slice("codes", F.lit(2), F.greatest(F.size("codes") - 1, F.lit(0)))
    products = F.aggregate(F.zip_with("codes", later, lambda a, b: F.coalesce((a - middle) * (b - middle), F.lit(0.0))),
                           F.lit(0.0), lambda s, x: s + x)
    rows = rows.select("*", zeros.alias("zeros"), (F.lit(1.0) + changes).alias("runs"), products.alias("products"))
    n, k = F.col("n"), F.col("k")
    uniform = (k / n * F.col("squares") - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    mean = 2 * F.col("zeros") * (n - F.col("zeros")) / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    run_test = F.when(spread > 0, (F.col("runs") - mean) / F.sqrt(F.when(spread > 0, spread))).otherwise(F.lit(10.0))
    serial = F.col("products") / ((k * k - 1) / 12 * F.sqrt(n - 1))
    smallest = F.least(_two_sided(uniform), _two_sided(run_test), _two_sided(serial))
    rows = rows.select("*", F.greatest(F.lit(1e-18), F.least(F.lit(1.0), smallest * 3)).alias("p"))
    return rows.drop("body", "alphabet", "k", "squares", "sides", "codes", "zeros", "runs", "products")


def _not_rejected(tokens: DataFrame, fdr: float) -> DataFrame:
    """Those tokens whose randomness the Benjamini-Hochberg rule doesn't reject in their stratum."""
    level = F.least(F.floor(-F.log2("p") * _BINS_PER_BIT).cast("int"), F.lit(BINS - 1))
    binned = tokens.select("*", F.floor(F.log2("n")).cast("int").alias("size_class"), level.alias("bin"))
    counts = binned.groupBy("encoding", "size_class", "bin").agg(F.count(F.lit(1)).alias("c"))
    stratum = Window.partitionBy("encoding", "size_class")
    at_least = stratum.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select("encoding", "size_class", "bin", F.sum("c").over(at_least).alias("as_small"),
                           F.sum("c").over(stratum).alias("all"))
    passing = F.pow(F.lit(2.0), -F.col("bin") / _BINS_PER_BIT) * F.col("all") <= fdr * F.col("as_small")
    cut = ranked.groupBy("encoding", "size_class").agg(F.min(F.when(passing, F.col("bin"))).alias("from_bin"))
    # one row for each encoding and power of two: a few hundred at most
    joined = binned.join(F.broadcast(cut), ["encoding", "size_class"])
    return joined.filter(F.col("from_bin").isNull() | (F.col("bin") < F.col("from_bin")))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 fdr: float = FDR) -> DataFrame:
    """One row for each document: (doc_id, spans), spans an array of (start, kind, end) in order;
    ``kind`` is a place in ``KINDS``."""
    found = _matches(docs, id_col, text_col)
    spans, _ = write_stage(_spans(found), "secret-spans")
    base = spans.filter("kind < 3").select("row", "kind", "start", "end")
    runs = spans.filter("kind = 3").select("row", "kind", "start", "end", F.col("match").alias("token"))
    tokens = _with_parts(runs).select("*", _encoding(F.col("token")).alias("encoding"))
    tested, _ = write_stage(randomness(tokens.filter("encoding IS NOT NULL")), "secret-tests")
    random = _not_rejected(tested, fdr).select("row", "kind", "start", "end")
    ordered = Window.partitionBy("row").orderBy("start", "kind")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    after = ordered.rowsBetween(1, Window.unboundedFollowing)
    is_base = F.col("kind") < 3
    merged = base.unionByName(random).select(
        "*", F.max(F.when(is_base, F.col("end"))).over(before).alias("reached"),
        F.min(F.when(is_base, F.col("start"))).over(after).alias("next"))
    overlaps = F.coalesce(F.col("reached") > F.col("start"), F.lit(False)) | F.coalesce(
        F.col("next") < F.col("end"), F.lit(False))
    apart = merged.filter(~is_base & ~overlaps).select("row", "kind", "start", "end")
    kept = base.unionByName(_joined(apart))
    by_text = kept.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    empty = F.array().cast(dict(by_text.dtypes)["spans"])
    return found.select("row", "doc_id").join(by_text, "row", "left").select(
        "doc_id", F.coalesce("spans", empty).alias("spans"))


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: (doc_id, n_assign, n_access, n_hex, base_sha256, spans)."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def text_of(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return secret_spans(docs, id_col, text_col).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(text_of(base).cast("binary"), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"))
