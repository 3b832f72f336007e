"""Oracle SQL (DuckDB dialect) for each registered query.

Written independently of the Spark operators: plain SQL over the driver
tables and the ``person_course`` view, aliased to the same column names.
Floats are rounded to 6 decimals (``+ 0.0`` folds ``-0.0``).  Numbers in text
are recognised by the same regex guards as the Spark side.
"""

from __future__ import annotations

from shroud.plans import catalog as Q
from shroud.sources.fixture import ORDER_BRAND_SQL, PERSON_COURSE_SQL

# Integer and float text, written out here independently of the engine.
INT_PATTERN = "^[+-]?[0-9]+$"
FLOAT_PATTERN = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

PC = f"pc AS ({PERSON_COURSE_SQL})"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join((PC,) + ctes) + "\n"


def _key(cols, sep="") -> str:
    parts = [f"COALESCE(CAST({c} AS VARCHAR), 'NULL')" for c in cols]
    if not parts:
        return "''"
    return f" || '{sep}' || ".join(parts) if sep else " || ".join(parts)


def _int(c: str) -> str:
    return f"(CASE WHEN regexp_matches({c}, '{INT_PATTERN}') THEN TRY_CAST({c} AS BIGINT) END)"


def _dbl(c: str) -> str:
    return f"(CASE WHEN regexp_matches({c}, '{FLOAT_PATTERN}') THEN TRY_CAST({c} AS DOUBLE) END)"


def _canon(c: str) -> str:
    return f"COALESCE(CAST({_int(c)} AS VARCHAR) = {c}, FALSE)"


def _r6(x: str) -> str:
    return f"(ROUND(CAST({x} AS DOUBLE), 6) + 0.0)"


def _nf(c: str) -> str:
    return f"(CASE WHEN {c} IS NULL OR {c} IN ('', 'NA') THEN '0' ELSE '1' END)"


def _flagk(cols, k, src="pc") -> list[str]:
    return [f"fk_keyed AS (SELECT *, {_key(cols)} AS kkey FROM {src})",
            "fk_sizes AS (SELECT kkey, COUNT(*) AS n FROM fk_keyed GROUP BY kkey)",
            f"fk AS (SELECT f.*, CASE WHEN s.n >= {k} THEN 'True' ELSE 'False' END AS kCheckFlag "
            "FROM fk_keyed f JOIN fk_sizes s ON f.kkey = s.kkey)"]


def _entropy_of(group_expr: str, src: str = "pc") -> str:
    return (f"(SELECT -SUM(p * log2(p)) FROM (SELECT COUNT(*) / SUM(COUNT(*)) OVER () AS p "
            f"FROM {src} GROUP BY {group_expr}))")


# Course sets as bit masks (bit = position in sorted course order); fine for
# the oracle, whose course catalogue is small.
_USER_MASKS = [
    "uc AS (SELECT DISTINCT user_id, course_id FROM pc WHERE user_id IS NOT NULL AND course_id IS NOT NULL)",
    "courses AS (SELECT course_id, CAST(row_number() OVER (ORDER BY course_id) - 1 AS INTEGER) AS pos "
    "FROM (SELECT DISTINCT course_id FROM uc))",
    "um AS (SELECT user_id, CAST(SUM(CAST(1 AS BIGINT) << pos) AS BIGINT) AS m "
    "FROM uc JOIN courses USING (course_id) GROUP BY user_id)",
    "cnt AS (SELECT m, COUNT(*) AS n FROM um GROUP BY m)",
]


def _combo_string(mask: str) -> str:
    return (f"(SELECT string_agg(CASE WHEN ({mask} >> pos) & 1 = 1 THEN '1' ELSE '0' END, '' ORDER BY pos) "
            "FROM courses)")


def _drop_ctes(k: int, n_comb: int, positive: bool) -> list[str]:
    f = "(CASE WHEN {x} > 0 THEN ({x}) * log2({x}) ELSE 0 END)"
    if n_comb == 1:
        cand = ("cand AS (SELECT CAST(1 AS BIGINT) << pos AS d, pos AS p1, pos AS p2 FROM courses)")
    else:
        cand = ("cand AS (SELECT (CAST(1 AS BIGINT) << a.pos) | (CAST(1 AS BIGINT) << b.pos) AS d, "
                "a.pos AS p1, b.pos AS p2 FROM courses a JOIN courses b ON a.pos < b.pos)")
    extra = " AND loss > 1e-9 AND loss < 99" if positive else ""
    return _USER_MASKS + [
        f"fl AS (SELECT m, n FROM cnt WHERE n < {k})",
        f"safe AS (SELECT m FROM cnt WHERE n >= {k})",
        cand,
        "aff AS (SELECT cand.d, fl.m, fl.n, fl.m & ~cand.d AS g FROM cand JOIN fl ON (fl.m & cand.d) <> 0)",
        "grp AS (SELECT d, g, SUM(n) AS a FROM aff GROUP BY d, g)",
        "grp2 AS (SELECT grp.d, grp.g, grp.a, COALESCE(fl.n, 0) AS ng, safe.m IS NOT NULL AS gsafe "
        "FROM grp LEFT JOIN fl ON fl.m = grp.g LEFT JOIN safe ON safe.m = grp.g)",
        "pg AS (SELECT d, SUM(" + f.format(x="a + ng") + " - " + f.format(x="ng") + ") AS gain FROM grp2 GROUP BY d)",
        "pcb AS (SELECT aff.d, SUM(" + f.format(x="aff.n") + ") AS own, "
        f"COUNT(CASE WHEN grp2.a + grp2.ng >= {k} OR grp2.gsafe THEN 1 END) AS n_change "
        "FROM aff JOIN grp2 ON aff.d = grp2.d AND aff.g = grp2.g GROUP BY aff.d)",
        "sc AS (SELECT pg.d, (pg.gain - pcb.own) / (SELECT SUM(n) FROM fl) AS loss, pcb.n_change, "
        "cand.p1, cand.p2 FROM pg JOIN pcb ON pg.d = pcb.d JOIN cand ON cand.d = pg.d)",
        f"best AS (SELECT d FROM sc WHERE n_change > 0{extra} ORDER BY ROUND(loss, 9), p1, p2 LIMIT 1)",
        f"acc AS (SELECT aff.m FROM aff JOIN grp2 ON aff.d = grp2.d AND aff.g = grp2.g "
        f"WHERE aff.d IN (SELECT d FROM best) AND (grp2.a + grp2.ng >= {k} OR grp2.gsafe))",
        "gone AS (SELECT pc.user_id, pc.course_id, (um.m IN (SELECT m FROM acc) AND "
        "COALESCE(((SELECT d FROM best) >> courses.pos) & 1 = 1, FALSE)) AS dropped "
        "FROM pc JOIN um USING (user_id) JOIN courses USING (course_id))",
    ]


def _greedy_ctes(k: int, most: int, positive: bool) -> list[str]:
    """The greedy loop as a recursion over (step, original mask, current mask, users)."""
    f = "(CASE WHEN {x} > 0 THEN ({x}) * log2({x}) ELSE 0 END)"
    extra = " AND loss > 1e-9 AND loss < 99" if positive else ""
    return _USER_MASKS + [
    "cand AS (SELECT CAST(1 AS BIGINT) << pos AS d, pos AS p1, pos AS p2, 1 AS size FROM courses UNION ALL "
    "SELECT (CAST(1 AS BIGINT) << a.pos) | (CAST(1 AS BIGINT) << b.pos), a.pos, b.pos, 2 FROM courses a JOIN courses b ON a.pos < b.pos)",
    f"""st(step, size, origin, cur, n, live) AS (
  SELECT 0, 1, m, m, CAST(n AS BIGINT), true FROM cnt
  UNION ALL (
  WITH now AS (SELECT * FROM st WHERE live),
  c AS (SELECT cur AS m, SUM(n) AS n FROM now WHERE cur <> 0 GROUP BY cur),
  fl AS (SELECT m, n FROM c WHERE n < {k}),
  aff AS (SELECT cand.d, cand.p1, cand.p2, fl.m, fl.n, fl.m & ~cand.d AS g FROM cand JOIN fl ON (fl.m & cand.d) <> 0
          WHERE cand.size = (SELECT MAX(size) FROM now)),
  grp AS (SELECT aff.d, aff.g, SUM(aff.n) AS a, MAX(CASE WHEN c.n < {k} THEN c.n ELSE 0 END) AS ng,
                 COALESCE(MAX(c.n) >= {k}, FALSE) AS gsafe
          FROM aff LEFT JOIN c ON c.m = aff.g GROUP BY aff.d, aff.g),
  pg AS (SELECT d, SUM({f.format(x='(a + COALESCE(ng, 0))')} - {f.format(x='COALESCE(ng, 0)')}) AS gain FROM grp GROUP BY d),
  pcb AS (SELECT aff.d, aff.p1, aff.p2, SUM({f.format(x='aff.n')}) AS own,
                 COUNT(CASE WHEN grp.a + COALESCE(grp.ng, 0) >= {k} OR grp.gsafe THEN 1 END) AS n_change
          FROM aff JOIN grp ON aff.d = grp.d AND aff.g = grp.g GROUP BY aff.d, aff.p1, aff.p2),
  sc AS (SELECT pg.d, (pg.gain - pcb.own) / (SELECT SUM(n) FROM fl) AS loss, pcb.n_change, pcb.p1, pcb.p2
         FROM pg JOIN pcb ON pg.d = pcb.d),
  best AS (SELECT d FROM sc WHERE n_change > 0{extra} ORDER BY ROUND(loss, 9), p1, p2 LIMIT 1),
  acc AS (SELECT aff.m FROM aff JOIN grp ON aff.d = grp.d AND aff.g = grp.g
          WHERE aff.d IN (SELECT d FROM best) AND (grp.a + COALESCE(grp.ng, 0) >= {k} OR grp.gsafe))
  SELECT now.step + 1, CASE WHEN b.d IS NULL THEN now.size + 1 ELSE now.size END, now.origin,
         CASE WHEN now.cur IN (SELECT m FROM acc) THEN now.cur & ~b.d ELSE now.cur END, now.n,
         b.d IS NOT NULL OR now.size < {most}
  FROM now LEFT JOIN best b ON true WHERE EXISTS (SELECT 1 FROM fl)))""",
    "fin AS (SELECT origin, cur, n FROM st WHERE step = (SELECT MAX(step) FROM st))",
    "left_over AS (SELECT cur, SUM(n) AS users FROM fin GROUP BY cur)",
    f"""kept AS (SELECT pc.user_id, pc.course_id FROM pc JOIN um USING (user_id) JOIN courses USING (course_id)
      JOIN fin ON fin.origin = um.m JOIN left_over USING (cur) WHERE (fin.cur >> courses.pos) & 1 = 1 AND left_over.users >= {k})"""]


def _iter_k_check(qis, k) -> str:
    q = len(qis)
    nf = [_nf(c) for c in qis]
    ctes = [f"t0 AS (SELECT user_id, course_id, {', '.join(qis)}, {' || '.join(nf)} AS nullSum, "
            "'False' AS kCheckFlag FROM pc)"]
    i = 0
    for bits in range(2 ** q):
        pattern = format(bits, f"0{q}b")
        if "0" not in pattern:
            continue
        valid = [c for c, b in zip(qis, pattern) if b == "1"]
        i += 1
        ctes.append(f"s{i} AS (SELECT *, {_key(valid)} AS nk FROM t{i-1})")
        ctes.append(f"c{i} AS (SELECT nk, COUNT(*) AS n FROM s{i} WHERE kCheckFlag = 'False' GROUP BY nk)")
        ctes.append(f"t{i} AS (SELECT s.user_id, s.course_id, {', '.join('s.' + c for c in qis)}, s.nullSum, "
                    f"CASE WHEN s.nullSum = '{pattern}' AND COALESCE(c.n, 0) >= {k} THEN 'True' "
                    f"ELSE s.kCheckFlag END AS kCheckFlag FROM s{i} s LEFT JOIN c{i} c ON s.nk = c.nk)")
    ctes.append(f"ikc AS (SELECT * FROM t{i})")
    return ctes


def _pseudonyms() -> tuple[str, str]:
    """CTEs: the ids of ``pc`` in the order of their salted hash; each id's pseudonym."""
    return ("ids AS (SELECT DISTINCT user_id FROM pc WHERE user_id IS NOT NULL)",
            f"rk AS (SELECT user_id, '{Q.PREFIX}' || lpad(CAST(row_number() OVER (ORDER BY sha256('{Q.SALT}' || user_id), "
            "user_id) AS VARCHAR), CAST(length(CAST(10 * (SELECT COUNT(DISTINCT user_id) + MAX(CASE WHEN user_id IS NULL "
            "THEN 1 ELSE 0 END) FROM pc) AS VARCHAR)) AS INTEGER), '0') AS userid_DI FROM ids)")


def _release_ctes(k: int, edu: str, zero: str) -> list[str]:
    """The release pipeline: ``pc_all`` all rows, ``pc`` without staff, ``rel`` the released rows."""
    high, bw, yob_bw = 2, 5, Q.RELEASE_YOB_BW
    qis = ["course_id", "country_DI", "gender_DI", "LoE_DI", "nforum_posts_DI", "YoB_DI"]
    a_, b_, c_ = ("(nevents = '' AND nchapters != '')", "(nevents = '' AND nforum_posts NOT IN ('0', 'zero'))",
                  "(nevents = '' AND ndays_act != '')")
    same = " AND ".join(f"a.{q} IS NOT DISTINCT FROM b.{q}" for q in qis)
    cols = ", ".join(qis)
    plain = [c for c in Q.PC_COLUMNS if c not in ("nforum_posts",)]
    return [
        f"pc_all AS ({PERSON_COURSE_SQL})",
        "pc AS (SELECT * FROM pc_all WHERE roles IS NULL OR roles NOT IN ('instructor', 'staff'))",
        *_pseudonyms(), *_greedy_ctes(k, 1, True),
        "uk AS (SELECT pc.* FROM pc JOIN kept USING (user_id, course_id))",
        "xs AS (SELECT country, COUNT(*) AS n, MIN(continent) AS p FROM uk WHERE country IS NOT NULL GROUP BY country)",
        f"x1 AS (SELECT {', '.join('uk.' + c for c in plain)}, {zero.replace('nforum_posts', 'uk.nforum_posts')} AS nforum_posts, "
        f"CASE WHEN xs.n >= {Q.RELEASE_COUNTRY_TH} AND uk.country NOT IN ('A1', 'A2', 'AP', 'EU', '') THEN uk.country ELSE xs.p END "
        "AS country_DI, CASE WHEN gender = 'NA' THEN '' ELSE gender END AS gender_DI, "
        f"{edu} AS LoE_DI FROM uk LEFT JOIN xs ON uk.country = xs.country)",
        f"x2 AS (SELECT *, CASE WHEN {_canon('nforum_posts')} AND {_int('nforum_posts')} >= {high} THEN '>= {high}' "
        "ELSE nforum_posts END AS pt FROM x1)",
        f"x3 AS ({_bins('pt', bw, 'x2', 'nforum_posts_DI')})",
        f"x4 AS ({_bins('YoB', yob_bw, 'x3', 'YoB_DI')})",
        f"x5 AS (SELECT *, CASE WHEN {a_} OR {b_} OR {c_} THEN '1' END AS incomplete_flag FROM x4)",
        f"x6 AS (SELECT {cols}, COUNT(*) AS n, COUNT(DISTINCT grade) + MAX(CASE WHEN grade IS NULL THEN 1 ELSE 0 END) AS nd "
        f"FROM x5 GROUP BY {cols})",
        "rel AS (SELECT a.* EXCLUDE (grade), CASE WHEN b.nd < 2 THEN ' ' ELSE a.grade END AS grade, rk.userid_DI "
        f"FROM x5 a JOIN x6 b ON {same} LEFT JOIN rk ON rk.user_id = a.user_id WHERE b.n >= {k})",
    ]


def _report_measures(src: str, staffless: str, k: int) -> str:
    """(measure, value) of the release report on one table; ``staffless``: its rows without staff."""
    keep = "(gender IS NULL OR gender NOT IN ('', 'NA', 'o'))"
    parts = [f"SELECT 'records' AS measure, CAST(COUNT(*) AS DOUBLE) AS value FROM {src}"]
    parts += [f"SELECT 'share:{v}=' || COALESCE({v}, 'NULL'), {_r6(f'COUNT(*) / (SELECT COUNT(*) FROM {src})')} "
              f"FROM {src} GROUP BY {v}" for v in ("viewed", "explored", "certified")]
    parts.append(f"SELECT 'gender:' || COALESCE(gender, 'NULL'), {_r6(f'COUNT(*) / (SELECT COUNT(*) FROM {src} WHERE {keep})')} "
                 f"FROM {src} WHERE {keep} GROUP BY gender")
    parts.append(f"SELECT 'mean_age', {_r6('SUM(2013 - y) / COUNT(y)')} FROM (SELECT {_int('YoB')} AS y FROM {src})")
    for c in ("nforum_posts", "YoB", "grade"):
        parts += [f"SELECT 'entropy:{c}', {_r6(_entropy_of(c, staffless))}",
                  f"SELECT 'mean:{c}', {_r6(f'(SELECT AVG({_dbl(c)}) FROM {staffless})')}",
                  f"SELECT 'sd:{c}', {_r6(f'(SELECT STDDEV_POP({_dbl(c)}) FROM {staffless})')}"]
    sets = (f"SELECT user_id, string_agg(DISTINCT course_id, ',' ORDER BY course_id) AS s FROM {src} "
            "WHERE user_id IS NOT NULL GROUP BY user_id")
    parts.append("SELECT 'unique_user_share', " + _r6(f"COALESCE(SUM(CASE WHEN n < {k} THEN n END), 0) / SUM(n)") +
                 f" FROM (SELECT s, COUNT(*) AS n FROM ({sets}) GROUP BY s)")
    return " UNION ALL ".join(parts)


def _utility(cols, src="pc") -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS variable, {_r6(_entropy_of(c, src))} AS entropy, "
            f"{_r6(f'(SELECT AVG({_dbl(c)}) FROM {src})')} AS mean, "
            f"{_r6(f'(SELECT STDDEV_POP({_dbl(c)}) FROM {src})')} AS sd")
    return " UNION ALL ".join(parts)


def _bins(col: str, bw: int, src: str, out: str) -> str:
    """Columns of ``src`` plus the bin label of ``col`` as ``out``."""
    x = _int(col)
    m = f"(SELECT MIN({x}) FROM {src})"
    label = f"CAST({x} - ({x} - {m}) % {bw} AS VARCHAR) || '-' || CAST({x} - ({x} - {m}) % {bw} + {bw - 1} AS VARCHAR)"
    return f"SELECT *, CASE WHEN {_canon(col)} THEN {label} ELSE {col} END AS {out} FROM {src}"


def oracle_sql() -> dict[str, str]:
    k = Q.K_ROWS
    sql: dict[str, str] = {}
    nul = ", ".join(f"COALESCE({c}, '') AS {c}" for c in Q.PC_COLUMNS)
    sql["load_source"] = _with() + f"SELECT {nul}, '' AS kkey, CAST(1 AS INTEGER) AS \"Count\" FROM pc"
    sql["derive_mapping"] = _with() + "SELECT country, MIN(continent) AS continent FROM pc GROUP BY country"
    sql["export_view"] = _with(*_flagk(Q.QI4, k)) + \
        "SELECT course_id, country, gender, LoE FROM fk WHERE kCheckFlag = 'True'"
    sql["export_csv"] = _with() + (
        "SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, COALESCE(d.text, '') AS text, COALESCE(d.lang, '') AS lang "
        "FROM documents d JOIN (SELECT lang, source, COUNT(*) AS n FROM documents GROUP BY lang, source) g "
        f"ON d.lang IS NOT DISTINCT FROM g.lang AND d.source IS NOT DISTINCT FROM g.source WHERE g.n >= {Q.EXPORT_K}")
    big = ("big AS (SELECT CAST(o_orderkey + 1000000000 AS VARCHAR) AS far, "
           "CAST(o_custkey % 10 + 1000000000 AS VARCHAR) AS far_narrow FROM orders)")
    sql["utility_large_values"] = _with(big) + _utility(["far", "far_narrow"], "big")
    sql["bin_average_large_values"] = _with() + (
        "SELECT o_orderkey, o_orderpriority, CAST(ROUND(AVG(o_custkey * 12345 + 0.25::DOUBLE) "
        "OVER (PARTITION BY o_orderpriority), 2) AS VARCHAR) AS o_orderpriority_avg FROM orders")
    sql["k_anonymity_path_cleared"] = _with() + " UNION ALL ".join(
        f"SELECT CAST({j} AS INTEGER) AS level, '{name}' AS added_variable, TRUE AS k_anonymous, "
        "CAST(0.0 AS DOUBLE) AS suppress_fraction" for j, name in enumerate(["core", "LoE"]))
    sql["set_constant"] = _with() + "SELECT user_id, course_id, CAST(NULL AS VARCHAR) AS export_flag, 'v1' AS release FROM pc"
    case = "CASE LoE " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in Q.RECODE_MAP.items())
    sql["recode"] = _with() + f"SELECT user_id, course_id, {case} ELSE LoE END AS LoE, {case} END AS LoE_new FROM pc"
    sql["recode_table"] = _with(
        "m AS (SELECT n_name AS key, MIN(r_name) AS value FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY n_name)") + \
        "SELECT user_id, course_id, country, m.value AS country_parent FROM pc LEFT JOIN m ON pc.country = m.key"
    sql["date_part_only"] = _with() + "SELECT user_id, course_id, start_time, split_part(start_time, 'T', 1) AS start_time_DI FROM pc"
    sql["drop_roles"] = _with() + "SELECT * FROM pc WHERE roles IS NULL OR roles NOT IN ('instructor', 'staff')"
    sql["blank_missing"] = _with() + \
        "SELECT user_id, course_id, gender, CASE WHEN gender = 'NA' THEN '' ELSE gender END AS gender_DI FROM pc"
    # The education recode
    edu = "CASE LoE " + " ".join(
        "WHEN '{}' THEN '{}'".format(a, b.replace("'", "''")) for a, b in
        [("", ""), ("NA", "NA"), ("a", "Secondary"), ("b", "Bachelor's"), ("el", "Less than Secondary"),
         ("hs", "Secondary"), ("jhs", "Less than Secondary"), ("learn", ""), ("m", "Master's"),
         ("none", ""), ("other", ""), ("p", "Doctorate"), ("p_oth", "Doctorate"), ("p_se", "Doctorate")]) + " END"
    sql["recode_education"] = _with() + f"SELECT user_id, course_id, LoE, {edu} AS LoE_DI FROM pc"
    zero = "CASE WHEN nforum_posts = '0' THEN 'zero' ELSE nforum_posts END"
    sql["mark_value"] = _with() + f"SELECT user_id, course_id, {zero} AS nforum_posts FROM pc"
    mz = f"mz AS (SELECT user_id, course_id, nevents, nchapters, ndays_act, {zero} AS nforum_posts FROM pc)"
    a_ = "(nevents = '' AND nchapters != '')"
    b_ = "(nevents = '' AND nforum_posts NOT IN ('0', 'zero'))"
    c_ = "(nevents = '' AND ndays_act != '')"
    sql["incomplete_flag"] = _with(mz) + \
        f"SELECT user_id, course_id, CASE WHEN {a_} OR {b_} OR {c_} THEN '1' END AS incomplete_flag FROM mz"
    sql["incomplete_counts"] = _with(mz) + (
        f"SELECT CAST(SUM(CASE WHEN {a_} THEN 1 END) AS BIGINT) AS n_events_blank_chapters, "
        f"CAST(SUM(CASE WHEN {b_} THEN 1 END) AS BIGINT) AS n_events_blank_posts, "
        f"CAST(SUM(CASE WHEN {c_} THEN 1 END) AS BIGINT) AS n_events_blank_days, "
        f"CAST(SUM(CASE WHEN {a_} OR {b_} OR {c_} THEN 1 END) AS BIGINT) AS n_incomplete FROM mz")
    sql["mark_nulls"] = _with() + f"SELECT user_id, course_id, {_nf('gender')} AS gender_NF, {_nf('YoB')} AS YoB_NF FROM pc"
    sql["with_kkey"] = _with() + f"SELECT user_id, course_id, {_key(Q.QI3)} AS kkey, {_key(Q.QI3, '|')} AS kkey_sep FROM pc"
    sql["censor"] = _with(*_flagk(Q.QI4, k)) + \
        "SELECT user_id, course_id, CASE WHEN kCheckFlag = 'False' THEN '' ELSE gender END AS gender FROM fk"
    sql["censor_to_parent"] = _with(*_flagk(Q.QI4, k)) + \
        "SELECT user_id, course_id, CASE WHEN kCheckFlag = 'False' THEN continent ELSE country END AS country_DI FROM fk"
    sql["to_number"] = _with() + f"SELECT user_id, course_id, YoB, {_dbl('YoB')} AS YoB_num FROM pc"
    combos = [
        "uc AS (SELECT DISTINCT user_id, course_id FROM pc WHERE user_id IS NOT NULL)",
        "cmb AS (SELECT user_id, string_agg(course_id, ',' ORDER BY course_id) AS combo FROM uc GROUP BY user_id)",
        "ccnt AS (SELECT combo, COUNT(*) AS n FROM cmb GROUP BY combo)",
    ]
    sql["suppress_unique_users"] = _with(*combos) + \
        f"SELECT pc.user_id, pc.course_id FROM pc JOIN cmb USING (user_id) JOIN ccnt USING (combo) WHERE ccnt.n >= {k}"
    sql["suppress_below_k"] = _with(*_flagk(Q.QI4, k)) + \
        "SELECT user_id, course_id, kkey FROM fk WHERE kCheckFlag = 'True'"
    named = ("nm AS (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
             "COALESCE(n.n_name, CAST(c_nationkey AS VARCHAR)) AS c_nationkey_cname FROM customer c "
             "LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey < 3) n ON c.c_nationkey = n.n_nationkey)")
    sql["lookup_name"] = _with(named) + "SELECT * FROM nm"
    sql["lookup_parent"] = _with(named, "par AS (SELECT n_name, MIN(r_name) AS r_name FROM nation JOIN region "
                                 "ON n_regionkey = r_regionkey GROUP BY n_name)") + \
        "SELECT c_custkey, c_nationkey_cname, par.r_name AS continent FROM nm LEFT JOIN par ON nm.c_nationkey_cname = par.n_name"
    sql["salted_hash"] = _with() + f"SELECT user_id, course_id, sha256('{Q.SALT}' || user_id) AS user_id_hash FROM pc"
    sql["pseudonymize"] = _with(
        "ids AS (SELECT DISTINCT user_id FROM pc WHERE user_id IS NOT NULL)",
        f"rk AS (SELECT user_id, row_number() OVER (ORDER BY sha256('{Q.SALT}' || user_id), user_id) AS r, "
        "(SELECT COUNT(DISTINCT user_id) + MAX(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) FROM pc) AS t "
        "FROM ids)") + (
        f"SELECT pc.user_id, pc.course_id, '{Q.PREFIX}' || lpad(CAST(r AS VARCHAR), "
        "CAST(length(CAST(10 * t AS VARCHAR)) AS INTEGER), '0') AS userid_DI FROM pc LEFT JOIN rk USING (user_id)")
    sql["value_counts"] = _with() + "SELECT gender, COUNT(*) AS n FROM pc GROUP BY gender"
    sql["total_records"] = _with() + "SELECT COUNT(*) AS n_records FROM pc"
    sql["value_shares"] = _with() + " UNION ALL ".join(
        f"SELECT '{v}' AS variable, {v} AS value, COUNT(*) AS n, {_r6(f'COUNT(*) / (SELECT COUNT(*) FROM pc)')} AS share "
        f"FROM pc GROUP BY {v}" for v in ("viewed", "explored", "certified"))
    keep = "(gender IS NULL OR gender NOT IN ('', 'NA', 'o'))"
    sql["gender_shares"] = _with() + (
        f"SELECT gender, COUNT(*) AS n, {_r6(f'COUNT(*) / (SELECT COUNT(*) FROM pc WHERE {keep})')} AS share "
        f"FROM pc WHERE {keep} GROUP BY gender")
    sql["gender_shares_as_written"] = _with("gc AS (SELECT gender, COUNT(*) AS n FROM pc GROUP BY gender)") + (
        "SELECT c.gender, c.n, " + _r6(
            "c.n / ((SELECT COUNT(*) FROM pc) - COALESCE((SELECT SUM(e.n) FROM gc e WHERE e.gender IN ('', 'NA', 'o') "
            "AND c.gender IS NOT NULL AND e.gender < c.gender), 0))") +
        f" AS share FROM gc c WHERE {keep.replace('gender', 'c.gender')}")
    sql["mean_age"] = _with() + (
        f"SELECT {_r6('SUM(2013 - y) / COUNT(y)')} AS mean_age FROM (SELECT {_int('YoB')} AS y FROM pc)")
    sql["entropy"] = _with() + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {_r6(_entropy_of(c))} AS entropy" for c in Q.ENTROPY_COLS)
    sql["table_entropy"] = _with() + f"SELECT {_r6(_entropy_of(_key(Q.PC_COLUMNS)))} AS entropy"
    after_cols = ["country_DI"] + Q.PERPLEXITY_COLS[1:]
    roll = (f"cs AS (SELECT country, COUNT(*) AS n, MIN(continent) AS p FROM pc WHERE country IS NOT NULL GROUP BY country)",
            f"ru AS (SELECT pc.*, CASE WHEN cs.n >= {Q.COUNTRY_TH} AND pc.country NOT IN ('A1', 'A2', 'AP', 'EU', '') "
            "THEN pc.country ELSE cs.p END AS country_DI FROM pc LEFT JOIN cs ON pc.country = cs.country)")
    h0 = _entropy_of(_key(Q.PERPLEXITY_COLS))
    h1 = _entropy_of(_key(after_cols), "ru")
    sql["perplexity_change"] = _with(*roll) + (
        f"SELECT {_r6(h0)} AS entropy_before, {_r6(h1)} AS entropy_after, "
        f"{_r6(f'pow(2.0, {h0}) - pow(2.0, {h1})')} AS perplexity_change")
    grains = " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST({i} AS INTEGER) AS pos, "
        f"(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)) / COUNT(*) AS g FROM pc"
        for i, c in enumerate(Q.ENTROPY_COLS))
    sql["grain_size"] = _with(f"gs AS ({grains})") + f"SELECT variable, pos, {_r6('g')} AS grain_size FROM gs"
    sql["pick_next_to_generalize"] = _with(f"gs AS ({grains})") + \
        f"SELECT variable, {_r6('g')} AS grain_size FROM gs ORDER BY g DESC, pos LIMIT 1"
    sql["utility_matrix"] = _with() + _utility(Q.UTILITY_COLS)
    dr = "dr AS (SELECT * FROM pc WHERE roles IS NULL OR roles NOT IN ('instructor', 'staff'))"
    sql["utility_diff"] = _with(dr, f"ua AS ({_utility(Q.UTILITY_COLS, 'dr')})", f"ub AS ({_utility(Q.UTILITY_COLS)})") + (
        "SELECT variable, " + ", ".join(f"{_r6(f'ua.{c} - ub.{c}')} AS d_{c}" for c in ("entropy", "mean", "sd")) +
        " FROM ua JOIN ub USING (variable)")
    bins = f"b AS ({_bins('nforum_posts', 2, 'pc', 'nforum_posts_DI')})"
    avg = (f"ba AS (SELECT nforum_posts_DI, CAST(ROUND(AVG({_dbl('nforum_posts')}), 2) AS VARCHAR) AS av "
           "FROM b WHERE nforum_posts_DI IS NOT NULL GROUP BY nforum_posts_DI)")
    sql["bin_average"] = _with(bins, avg) + (
        "SELECT user_id, course_id, b.nforum_posts_DI, ba.av AS nforum_posts_DI_avg "
        "FROM b LEFT JOIN ba ON b.nforum_posts_DI = ba.nforum_posts_DI")
    sql["roll_up_rare"] = _with(*roll) + "SELECT user_id, course_id, country, country_DI FROM ru"
    sql["tail_candidates"] = _with() + (
        f"SELECT {_int('nforum_posts')} AS value, COUNT(*) AS n FROM pc WHERE {_int('nforum_posts')} IS NOT NULL "
        "GROUP BY 1 HAVING COUNT(*) < 30")
    x = _int("nforum_posts")
    sql["trim_tails"] = _with() + (
        f"SELECT user_id, course_id, nforum_posts, CASE WHEN {_canon('nforum_posts')} THEN "
        f"(CASE WHEN {x} >= 5 THEN '>= 5' WHEN {x} <= 1 THEN '<= 1' ELSE nforum_posts END) "
        "ELSE nforum_posts END AS nforum_posts_DI FROM pc")
    sql["bin_numeric"] = _with(f"b AS ({_bins('YoB', 5, 'pc', 'YoB_DI')})") + "SELECT user_id, course_id, YoB, YoB_DI FROM b"
    sql["bin_numeric_part"] = _with(
        "pt AS (SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size FROM part)",
        f"b AS ({_bins('p_size', 7, 'pt', 'p_size_DI')})") + "SELECT p_partkey, p_size, p_size_DI FROM b"
    y = _int("nforum_posts")
    gn = [
        f"g1 AS (SELECT user_id, course_id, {zero} AS nforum_posts FROM pc)",
        f"g2 AS (SELECT *, CASE WHEN {_canon('nforum_posts')} AND {y} >= 5 THEN '>= 5' ELSE nforum_posts END AS t FROM g1)",
        f"g3 AS ({_bins('t', 2, 'g2', 'nforum_posts_DI')})",
        f"g4 AS (SELECT nforum_posts_DI, CAST(ROUND(AVG({_dbl('nforum_posts')}), 2) AS VARCHAR) AS av FROM g3 "
        "WHERE nforum_posts_DI IS NOT NULL GROUP BY nforum_posts_DI)",
    ]
    sql["generalize_numeric"] = _with(*gn) + (
        "SELECT user_id, course_id, nforum_posts, g3.nforum_posts_DI, g4.av AS nforum_posts_DI_avg "
        "FROM g3 LEFT JOIN g4 ON g3.nforum_posts_DI = g4.nforum_posts_DI")
    sql["k_anonymity"] = _with(f"kg AS (SELECT {_key(Q.QI3)} AS kk, COUNT(*) AS n FROM pc GROUP BY kk)") + (
        f"SELECT COALESCE(SUM(CASE WHEN n < {k} THEN n END), 0) = 0 AS k_anonymous, "
        f"{_r6(f'COALESCE(SUM(CASE WHEN n < {k} THEN n END), 0) / SUM(n)')} AS suppress_fraction, "
        f"CAST(SUM(n) AS BIGINT) AS rows, CAST(COALESCE(SUM(CASE WHEN n < {k} THEN n END), 0) AS BIGINT) AS rows_below_k FROM kg")
    core, opt = ["continent", "gender"], ["LoE", "course_id", "country"]
    levels = []
    for j, name in enumerate(["core"] + opt):
        cols = core + opt[:j]
        levels.append(
            f"SELECT CAST({j} AS INTEGER) AS level, '{name}' AS added_variable, "
            f"COALESCE(SUM(CASE WHEN n < {k} THEN n END), 0) = 0 AS k_anonymous, "
            f"{_r6(f'COALESCE(SUM(CASE WHEN n < {k} THEN n END), 0) / SUM(n)')} AS suppress_fraction "
            f"FROM (SELECT {_key(cols)} AS kk, COUNT(*) AS n FROM pc GROUP BY kk)")
    sql["k_anonymity_path"] = _with() + " UNION ALL ".join(levels)
    sql["iter_k_check"] = _with(*_iter_k_check(["gender", "YoB"], Q.K4_K)) + \
        "SELECT user_id, course_id, nullSum, kCheckFlag FROM ikc"
    kk = Q.K4_K
    sql["k_anonymity_checked"] = _with(*_iter_k_check(["gender", "YoB"], kk),
                                       f"kg AS (SELECT {_key(['gender', 'YoB'])} AS kk, COUNT(*) AS n FROM ikc "
                                       "WHERE kCheckFlag = 'False' GROUP BY kk)") + (
        f"SELECT COALESCE(SUM(CASE WHEN n < {kk} THEN n END), 0) = 0 AS k_anonymous, "
        f"{_r6(f'CASE WHEN COALESCE(SUM(n), 0) > 0 THEN COALESCE(SUM(CASE WHEN n < {kk} THEN n END), 0) / SUM(n) ELSE 0.0 END')} AS suppress_fraction, "
        f"CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows, "
        f"CAST(COALESCE(SUM(CASE WHEN n < {kk} THEN n END), 0) AS BIGINT) AS rows_below_k FROM kg")
    sql["flag_k"] = _with(*_flagk(Q.QI4, k)) + "SELECT user_id, course_id, kkey, kCheckFlag FROM fk"
    ld = [f"lk AS (SELECT *, {_key(['country', 'gender', 'LoE'])} AS kkey FROM pc)",
          "ls AS (SELECT kkey, COUNT(DISTINCT grade) + MAX(CASE WHEN grade IS NULL THEN 1 ELSE 0 END) AS nd FROM lk GROUP BY kkey)"]
    sql["l_diversity"] = _with(*ld) + \
        "SELECT user_id, course_id, lk.kkey, CASE WHEN nd < 2 THEN ' ' ELSE grade END AS grade FROM lk JOIN ls ON lk.kkey = ls.kkey"
    ldd = [f"dk AS (SELECT d.doc_id, {_key(['lang', 'source'])} AS kkey, CAST(l.toxic AS VARCHAR) AS toxic "
           "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)",
           "ds AS (SELECT kkey, COUNT(DISTINCT toxic) + MAX(CASE WHEN toxic IS NULL THEN 1 ELSE 0 END) AS nd FROM dk GROUP BY kkey)"]
    sql["l_diversity_docs"] = _with(*ldd) + \
        "SELECT doc_id, dk.kkey, CASE WHEN nd < 2 THEN ' ' ELSE toxic END AS toxic FROM dk JOIN ds ON dk.kkey = ds.kkey"
    sql["course_combos"] = _with(*_USER_MASKS) + f"SELECT user_id, {_combo_string('um.m')} AS course_combo FROM um"
    uflag = _USER_MASKS + [
        f"uf AS (SELECT pc.user_id, pc.course_id, {_combo_string('um.m')} AS course_combo, "
        f"CASE WHEN cnt.n < {k} THEN 'True' ELSE 'False' END AS uniqUserFlag "
        "FROM pc JOIN um USING (user_id) JOIN cnt USING (m))"]
    sql["user_combos"] = _with(*uflag) + "SELECT DISTINCT user_id, course_combo FROM uf WHERE uniqUserFlag = 'True'"
    sql["combo_counts"] = _with(*_USER_MASKS) + f"SELECT {_combo_string('m')} AS course_combo, n AS n_users FROM cnt"
    sql["unique_user_share"] = _with(*_USER_MASKS) + (
        f"SELECT {_r6(f'COALESCE(SUM(CASE WHEN n < {k} THEN n END), 0) / SUM(n)')} AS unique_share, "
        f"CAST(SUM(n) AS BIGINT) AS users, CAST(COALESCE(SUM(CASE WHEN n < {k} THEN n END), 0) AS BIGINT) AS unique_users, "
        f"COUNT(CASE WHEN n < {k} THEN 1 END) AS unique_combos FROM cnt")
    sql["flag_unique_users"] = _with(*uflag) + "SELECT * FROM uf"
    names = "(SELECT string_agg(course_id, ',' ORDER BY pos) FROM courses WHERE (sc.d >> pos) & 1 = 1)"
    for key, n_comb, positive in (("best_drop_single", 1, False), ("best_drop_multi", 2, True)):
        sql[key] = _with(*_drop_ctes(k, n_comb, positive)) + (
            f"SELECT {names} AS drop_courses, {_r6('loss')} AS loss, n_change, "
            "d IN (SELECT d FROM best) AS chosen FROM sc")
        sql[f"{key}_brands"] = sql[key].replace(PC, f"pc AS ({ORDER_BRAND_SQL})", 1)
    sql["flag_unique_users_brands"] = sql["flag_unique_users"].replace(PC, f"pc AS ({ORDER_BRAND_SQL})", 1)
    for key, most, positive in (("user_k_anonymity_single", 1, False), ("user_k_anonymity_multi", 2, True)):
        sql[key] = _with(*_greedy_ctes(k, most, positive)).replace("WITH ", "WITH RECURSIVE ", 1) + "SELECT * FROM kept"
    sql["apply_drops"] = _with(*_drop_ctes(k, 1, False)) + "SELECT user_id, course_id FROM gone WHERE NOT dropped"
    sql["drop_tally"] = _with(*_drop_ctes(k, 1, False)) + \
        "SELECT course_id, COUNT(*) AS rows_dropped FROM gone WHERE dropped GROUP BY course_id"
    release = _release_ctes(k, edu, zero)
    sql["anonymize"] = "WITH RECURSIVE " + ",\n".join(release) + (
        "\nSELECT userid_DI, course_id, country_DI, gender_DI, LoE_DI, nforum_posts_DI, YoB_DI, grade, incomplete_flag FROM rel")
    sql["release_report"] = "WITH RECURSIVE " + ",\n".join(release + [
        f"mo AS ({_report_measures('pc_all', 'pc', k)})", f"mr AS ({_report_measures('rel', 'rel', k)})"]) + (
        f"\nSELECT COALESCE(mo.measure, mr.measure) AS measure, {_r6('mo.value')} AS original, {_r6('mr.value')} AS released "
        "FROM mo FULL JOIN mr ON mo.measure = mr.measure "
        "UNION ALL SELECT 'release:suppress_fraction', NULL, 0.0 UNION ALL SELECT 'release:uniform_groups_shown', NULL, "
        "CAST((SELECT COUNT(*) FROM (SELECT COUNT(DISTINCT grade) + MAX(CASE WHEN grade IS NULL THEN 1 ELSE 0 END) AS nd, "
        "COUNT(CASE WHEN grade = ' ' THEN 1 END) AS blank FROM rel GROUP BY course_id, country_DI, gender_DI, LoE_DI, "
        "nforum_posts_DI, YoB_DI) WHERE nd < 2 AND blank = 0) AS DOUBLE)")
    # pipeline stages (roll-up, recodes, posts recipe, birth-year bins,
    # incomplete flag, then final key, k = 3, suppression, l-diversity)
    qis = ["course_id", "country_DI", "gender_DI", "LoE_DI", "nforum_posts_DI", "YoB_DI"]
    pm = "posts_m"
    stages = list(roll) + [
        f"rs2 AS (SELECT ru.*, CASE WHEN gender = 'NA' THEN '' ELSE gender END AS gender_DI, "
        f"{edu} AS LoE_DI, {zero} AS {pm} FROM ru)",
        f"rs3 AS (SELECT *, CASE WHEN {_canon(pm)} AND {_int(pm)} >= 5 THEN '>= 5' ELSE {pm} END AS pt FROM rs2)",
        f"rs4 AS ({_bins('pt', 2, 'rs3', 'nforum_posts_DI')})",
        f"rs5 AS (SELECT nforum_posts_DI AS b, CAST(ROUND(AVG({_dbl(pm)}), 2) AS VARCHAR) AS av FROM rs4 "
        "WHERE nforum_posts_DI IS NOT NULL GROUP BY nforum_posts_DI)",
        "rs6 AS (SELECT rs4.*, rs5.av AS nforum_posts_DI_avg FROM rs4 LEFT JOIN rs5 ON rs4.nforum_posts_DI = rs5.b)",
        f"rs7 AS ({_bins('YoB', 5, 'rs6', 'YoB_DI')})",
        f"rs8 AS (SELECT *, CASE WHEN (nevents = '' AND nchapters != '') OR (nevents = '' AND {pm} NOT IN ('0', 'zero')) "
        "OR (nevents = '' AND ndays_act != '') THEN '1' END AS incomplete_flag FROM rs7)",
        f"rs9 AS (SELECT *, {_key(qis)} AS kkey FROM rs8)",
        "rs10 AS (SELECT kkey, COUNT(*) AS n FROM rs9 GROUP BY kkey)",
        "rs11 AS (SELECT rs9.* FROM rs9 JOIN rs10 ON rs9.kkey = rs10.kkey WHERE rs10.n >= 3)",
        "rs12 AS (SELECT kkey, COUNT(DISTINCT grade) + MAX(CASE WHEN grade IS NULL THEN 1 ELSE 0 END) AS nd "
        "FROM rs11 GROUP BY kkey)",
    ]
    sql["release_stages"] = _with(*stages) + (
        "SELECT user_id, course_id, rs11.kkey, CASE WHEN nd < 2 THEN ' ' ELSE grade END AS grade, "
        "nforum_posts_DI_avg, incomplete_flag FROM rs11 JOIN rs12 ON rs11.kkey = rs12.kkey")
    return sql
