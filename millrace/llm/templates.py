"""Removal of recurring log-like lines by a template tree, in DataFrame operations only.

The tree has a fixed depth: a line goes by its number of tokens, then by its leading tokens, to a leaf. Tokens
with a digit are variable from the start. In a leaf, a token at a place can be constant if enough lines of
the leaf have it there; all others are variable (<*>). A line has a template for each share 1 / 2**k of its leaf:
the tokens that hold this share at their places are constant there. So a field whose values are all frequent is
variable at a large share, and multiplying the input changes no template of the shares it had. A template of which
enough tokens are constant and that enough documents hold is dropped everywhere. A line has no more templates than
the number of lines of its leaf has binary digits.

Leaves with too few lines for any template end early, so only lines of recurring leaves are taken apart, each
distinct line once. Hot lines, leaves and templates are summed before they are shuffled, and joins have one row
per key on one side, so Spark can split the other.

Lines of fewer tokens than the tree is deep go by the leading tokens they have. A line that enough documents hold word
for word is a template of its own, whatever its digits.

Defined results: null is the empty text, which is one empty line. Lines are parted by \\n and tokens by blanks;
lines without a token are kept. Repeated rows are documents each.
Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.barrier import evaluated_once
from millrace.llm.arrow_text import free_name
from millrace.scratch import stage

#: Leading tokens that lead to a leaf, below the number of tokens.
LEADING = 3
#: A token can be constant from so many lines on, a template recurs from so many documents on.
MIN_LINES = 10
MIN_DOCUMENTS = 10
#: Share of tokens of a dropped template that are constant.
CONSTANT_SHARE = 0.5

_TOKEN = r"[^\x20\x09-\x0D]+"
_ANY = "<*>"
_SEED = 77


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(_ANY)).otherwise(token)


def _hashed(documents: DataFrame, *kept: Column) -> DataFrame:
    """Each line with two hashes that stand for it."""
    exploded = documents.select(*kept, F.posexplode(_lines(F.col("text"))).alias("line_no", "line"))
    return exploded.withColumns({"line_a": F.xxhash64("line"), "line_b": F.xxhash64(F.lit(_SEED), F.col("line"))})


def _placed(documents: DataFrame) -> DataFrame:
    """Each line with a token, with its tokens and leaf."""
    tokens = F.regexp_extract_all(F.col("line"), F.lit(_TOKEN), F.lit(0))
    held = _hashed(documents).withColumn("tokens", tokens).where(F.size("tokens") > 0)
    leading = [_masked(F.get("tokens", F.lit(k))) for k in range(LEADING)]  # null behind the end
    return held.withColumn("leaf", F.xxhash64(F.size("tokens"), *leading))


def _dropped_lines(documents: DataFrame) -> DataFrame:
    """line_a, line_b of every line whose template recurs."""
    lines = _placed(documents)
    leaves = lines.groupBy("leaf").agg(F.count("*").alias("n")).where(f"n >= {MIN_LINES}")
    leaves = leaves.withColumnRenamed("n", "leaf_rows")
    distinct = (
        lines.join(stage(leaves, "leaves"), "leaf")
        .groupBy("leaf", "line_a", "line_b")
        .agg(F.count("*").alias("rows"), F.first("leaf_rows").alias("leaf_rows"), F.first("tokens").alias("tokens"))
    )
    distinct = stage(distinct, "distinct-lines")
    tokens = distinct.select(
        "leaf", "line_a", "line_b", "rows", "leaf_rows", F.posexplode("tokens").alias("place", "token")
    ).withColumn("token", _masked(F.col("token")))
    constant = (
        tokens.where(F.col("token") != _ANY)
        .groupBy("leaf", "place", "token")
        .agg(F.sum("rows").alias("n"), F.first("leaf_rows").alias("leaf_rows"))
        .where(f"n >= {MIN_LINES}")
        .select("leaf", "place", "token", F.length(F.bin(F.expr("leaf_rows div n"))).alias("level"))
    )
    constant = stage(constant, "constant-tokens")
    held = (
        tokens.join(constant, ["leaf", "place", "token"], "left")
        .groupBy("leaf", "line_a", "line_b")
        .agg(
            F.array_sort(F.collect_list(F.struct("place", "token", "level"))).alias("all"),
            F.collect_set("level").alias("levels"),
            F.count("level").alias("constants"),
            F.count("*").alias("length"),
        )
        .where(F.col("constants") >= CONSTANT_SHARE * F.col("length"))
    )
    # A level is a share of the leaf; the last has all tokens of enough lines.
    general = (
        held.select("leaf", "line_a", "line_b", "all", "length", F.explode("levels").alias("at"))
        .where(F.size(F.filter("all", lambda t: t["level"] <= F.col("at"))) >= CONSTANT_SHARE * F.col("length"))
        .withColumn(
            "shown", F.transform("all", lambda t: F.when(t["level"] <= F.col("at"), t["token"]).otherwise(_ANY))
        )
        .select("leaf", "line_a", "line_b", F.sha2(F.array_join("shown", " "), 256).alias("template"))
    )
    own = F.concat(F.lit("="), F.hex("line_a"), F.hex("line_b")).alias("template")
    word_for_word = distinct.where(f"rows >= {MIN_DOCUMENTS}").select("leaf", "line_a", "line_b", own)
    general = stage(general.unionByName(word_for_word), "templates")
    held = _hashed(documents.withColumn("_at", F.monotonically_increasing_id()), F.col("_at")).select(
        "_at", "line_a", "line_b"
    )
    recurring = (
        held.join(general, ["line_a", "line_b"])
        .groupBy("leaf", "template", "_at")
        .agg(F.lit(1).alias("one"))
        .groupBy("leaf", "template")
        .agg(F.count("*").alias("documents"))
        .where(f"documents >= {MIN_DOCUMENTS}")
    )
    dropped = general.join(recurring, ["leaf", "template"]).select("line_a", "line_b").distinct()
    return stage(dropped, "dropped-lines")


def drop_templates(documents: DataFrame) -> tuple[DataFrame, tuple[str, str]]:
    """``documents`` without the lines of recurring templates, and the names of two columns added.

    They hold the number of lines of the text and of those dropped.
    """
    text = documents.select(F.coalesce("text", F.lit("")).alias("text"))
    ids = {"text_a": F.xxhash64("text"), "text_b": F.xxhash64(F.lit(_SEED), F.col("text"))}
    gone = (
        _hashed(text.withColumns(ids), F.col("text_a"), F.col("text_b"))
        .join(_dropped_lines(text), ["line_a", "line_b"])
        .groupBy("text_a", "text_b")
        .agg(F.collect_set("line_no").alias("gone"))  # no more than the text has lines
    )
    gone = stage(gone, "gone")
    n_lines, n_dropped = free_name(documents, "n_lines"), free_name(documents, "n_dropped")
    a, b, places, parts = (free_name(documents, c) for c in ("text_a", "text_b", "gone", "parts"))
    gone = gone.toDF(a, b, places)
    full = F.coalesce(F.col("text"), F.lit(""))
    named = documents.withColumns({a: F.xxhash64(full), b: F.xxhash64(F.lit(_SEED), full)})
    # Cut once: an expression inside the look-ups below would be cut again for each line.
    cut = evaluated_once(named.join(gone, [a, b], "left").drop(a, b).withColumn(parts, _lines(F.col("text"))))
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(places))
    kept = F.transform(left, lambda i: F.get(F.col(parts), i))
    return (
        cut.withColumns(
            {
                n_lines: F.size(parts).cast("long"),
                n_dropped: F.coalesce(F.size(places), F.lit(0)).cast("long"),
                "text": F.when(F.col(places).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
            }
        ).select(*[F.col(f"`{c}`") for c in documents.columns], n_lines, n_dropped),
        (n_lines, n_dropped),
    )


def templates_query(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept text of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept, (n_lines, n_dropped) = drop_templates(documents)
    return kept.select("doc_id", n_lines, n_dropped, F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_LEADING_SQL = ", ".join(f"masked[{k + 1}]" for k in range(LEADING))
ORACLE = f"""
WITH lines AS (
    SELECT row_number() OVER () AS doc_row, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), exploded AS (
    SELECT doc_row, unnest(range(1, len(parts) + 1)) AS line_no, unnest(parts) AS line FROM lines
), tokened AS (
    SELECT *, regexp_extract_all(line, '{_TOKEN}') AS tokens FROM exploded
), placed AS (
    SELECT *, list_transform(tokens, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{_ANY}' ELSE t END) AS masked
    FROM tokened WHERE len(tokens) > 0
), leaved AS (
    SELECT *, concat_ws(' ', len(tokens), {_LEADING_SQL}) AS leaf FROM placed
), recurring_leaves AS (
    SELECT leaf, count(*) AS leaf_rows FROM leaved GROUP BY leaf HAVING count(*) >= {MIN_LINES}
), distinct_lines AS (
    SELECT leaf, line, any_value(masked) AS masked, count(*) AS n
    FROM leaved WHERE leaf IN (SELECT leaf FROM recurring_leaves) GROUP BY leaf, line
), spread AS (
    SELECT leaf, line, n, unnest(range(1, len(masked) + 1)) AS place, unnest(masked) AS token FROM distinct_lines
), constant AS (
    SELECT leaf, place, token, length(bin(any_value(leaf_rows) // sum(n)::BIGINT)) AS level
    FROM spread JOIN recurring_leaves USING (leaf) WHERE token <> '{_ANY}'
    GROUP BY leaf, place, token HAVING sum(n) >= {MIN_LINES}
), leveled AS (
    SELECT s.leaf, s.line, s.place, s.token, c.level FROM spread s LEFT JOIN constant c USING (leaf, place, token)
), levels AS (
    SELECT DISTINCT leaf, line, level AS upto FROM leveled WHERE level IS NOT NULL
), general AS (
    SELECT leaf, line, string_agg(CASE WHEN level <= upto THEN token ELSE '{_ANY}' END, ' ' ORDER BY place) AS template
    FROM leveled JOIN levels USING (leaf, line) GROUP BY leaf, line, upto
    HAVING count(*) FILTER (WHERE level <= upto) >= {CONSTANT_SHARE} * count(*)
    UNION ALL SELECT leaf, line, '=' || line FROM distinct_lines WHERE n >= {MIN_DOCUMENTS}
), recurring AS (
    SELECT g.leaf, g.template FROM leaved JOIN general g USING (leaf, line)
    GROUP BY g.leaf, g.template HAVING count(DISTINCT doc_row) >= {MIN_DOCUMENTS}
), dropped AS (
    SELECT DISTINCT line FROM general JOIN recurring USING (leaf, template)
), gone AS (
    SELECT doc_row, list(line_no) AS gone FROM exploded WHERE line IN (SELECT line FROM dropped) GROUP BY doc_row
)
SELECT doc_id, CAST(len(parts) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_dropped,
    sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(parts) + 1),
        lambda i: NOT list_contains(coalesce(gone, []), i)), lambda i: parts[i]), chr(10)), '')) AS kept_sha256
FROM lines LEFT JOIN gone USING (doc_row)
"""
