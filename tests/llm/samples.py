"""Rows that every operator must take: NULLs, empty and long texts, ties, repeats, clashing names."""

LONG = "lorem Ipsum dolor sit amet " * 4000 + "end"
ROWS = [
    (1, "Hello World this is a plain test of seven words"),
    (1, "Hello World this is a plain test of seven words"),
    (2, None),
    (3, ""),
    (None, "hello world THIS is a plain test of seven words"),
    (None, None),
    (4, LONG),
    (5, "Élan vital été\n\n  two  spaces\tand a tab\r\n"),
    (6, "12345 !!! ..."),
    (7, "日本語のテキスト" * 50),
    (8, "tie"), (9, "TIE"), (10, "tie"),
]
EXTRA = ["row", "key", "run", "score", "kept", "fp", "hits", "token_ids", "decoded", "n_tokens", "place", "span",
         "row_key", "contained_items", "quality_score", "text_sha256"]


def documents(spark, rows=None, extra=True):
    """``documents`` with columns whose names clash with those that operators make."""
    rows = ROWS if rows is None else rows
    names = EXTRA if extra else []
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    schema += "".join(f", {n} string" for n in names)
    made = [(i, t, "en" if t and len(t) % 2 else None, None, None, *[f"x{j}" for j in range(len(names))])
            for i, t in rows]
    return spark.createDataFrame(made, schema)


def ident(row):
    return tuple((v is not None, str(v)) for v in row)


def union_find(n, links):
    """Smallest member of the component of each of n items."""
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
