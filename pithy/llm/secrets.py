"""Secret scans whose candidates are judged by how many repositories and owners hold them.

DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pithy.llm.common import free_name
from pithy.session import written

#: Kind, pattern, group that holds the secret, least length of that group.
KINDS = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
     r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # a run of 24+ is what [0-9a-f]+ matches there
)
ORDER = ("assign", "access", "hex", "live", "example")
LIVE, EXAMPLE = "live", "example"
PLACEHOLDER = "[SECRET]"
#: Words of values that stand for a credential.
STANDS_FOR = "example|sample|placeholder|change_?-?me|your[-_.]|dummy|redacted|xxxx"


def matches(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Array of (kind, gap, whole, value): leftmost matches with the characters before each since the last."""
    lit = F.lit(pattern)
    values = F.regexp_extract_all(text, lit, F.lit(group))
    whole = F.regexp_extract_all(text, lit, F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x).cast("long"))
    found = F.zip_with(
        F.arrays_zip(whole.alias("w"), values.alias("v")), F.slice(gaps, F.lit(1), F.size(gaps) - 1),
        lambda m, gap: F.struct(
            F.lit(kind).alias("kind"), gap.alias("gap"), F.char_length(m["w"]).cast("long").alias("length"),
            (F.char_length(m["w"]) - F.char_length(m["v"])).cast("long").alias("lead"), m["v"].alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:string,gap:bigint,length:bigint,lead:bigint,value:string>>")
    return F.when(F.rlike(text, lit), found).otherwise(none)


def base_spans(rows: DataFrame) -> DataFrame:
    """(doc, tkey, kind, start, end, from, value) of every base match.

    rows: distinct (doc, tkey) with `found`, the arrays of `matches`. Only matches
    are shuffled, never texts.
    """
    each = rows.select("doc", "tkey", F.explode("found").alias("of")).select("doc", "tkey", F.posexplode("of").alias("i", "m"))
    order = Window.partitionBy("doc", "tkey", "m.kind").orderBy("i")
    least = reduce(lambda c, k: c.when(F.col("m.kind") == k[0], k[3]), KINDS[1:], F.when(F.col("m.kind") == KINDS[0][0], KINDS[0][3]))
    return (
        each.withColumn("end", F.sum(F.col("m.gap") + F.col("m.length")).over(order))
        .where(F.char_length("m.value") >= least)
        .select("doc", "tkey", "m.kind", (F.col("end") - F.col("m.length")).alias("start"), "end",
                (F.col("end") - F.col("m.length") + F.col("m.lead")).alias("from"), F.col("m.value").alias("value"))
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """(digest, owners, repositories): in how many distinct owners and repositories a candidate occurs.

    candidates: digest, owner, repository. A repository belongs to its owner. Three
    partial aggregates; a value that fills the corpus sends one row per task.
    """
    return (
        candidates.groupBy("digest", "owner", "repository").agg(F.lit(1).alias("one"))
        .groupBy("digest", "owner").agg(F.count("*").alias("n"))
        .groupBy("digest").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))
    )


def looks_random(value: Column) -> Column:
    """Long, of many different characters, and with digits: what generated credentials are."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return (F.char_length(value) >= 16) & (different >= 8) & F.rlike(value, F.lit("[0-9]"))


def full_verdict(
    value: Column, kind: Column, owners: Column, repositories: Column, example_owners: int, example_repositories: int = 20,
) -> Column:
    """By owners and repositories; null only for what does not look like a credential and is not widely copied.

    Many owners make any value an example. Below that, access keys and random-looking
    values are live in however many repositories; so is any other assigned value of
    four different characters, unless many repositories hold it. A value that names
    itself a placeholder does not count as random.
    """
    stands_for = F.rlike(F.lower(value), F.lit(STANDS_FOR))
    strong = looks_random(value) & ~stands_for | F.rlike(value, F.lit("^AKIA[A-Z0-9]{16,}$"))
    assigned = (kind == KINDS[0][0]) & (F.size(F.array_distinct(F.split(value, ""))) >= 4)
    return (
        F.when(owners >= example_owners, EXAMPLE).when(strong, LIVE)
        .when(repositories >= example_repositories, EXAMPLE).when(assigned, LIVE)
    )


def joined_spans(kinds: Column) -> Column:
    """kind:start:end of the sorted structs, comma-joined."""
    return F.array_join(F.transform(kinds, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def judged_spans(
    docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str, example_owners: int,
    rule: Callable[..., Column],
) -> tuple[DataFrame, DataFrame]:
    """The rows (doc, tkey, one per row of docs) and all spans (doc, tkey, kind, start, end)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(text).alias("tkey"),
        F.col(owner_col).cast("string").alias("owner"), F.col(repo_col).cast("string").alias("repository"),
        F.filter(F.array(*[matches(text, k, p, g) for k, p, g, _ in KINDS]), lambda x: F.size(x) > 0).alias("found"),
    )
    rows = written(rows, "candidates")
    # Copies of a row count once per owner and repository, and give one set of spans.
    distinct = rows.where(F.size("found") > 0).groupBy("doc", "tkey").agg(F.any_value("found").alias("found"))
    base = written(base_spans(distinct).withColumn("digest", F.sha2("value", 256)), "base-spans")
    held = rows.where(F.size("found") > 0).select(F.col("doc").alias("d"), F.col("tkey").alias("t"), "owner", "repository").distinct()
    of = base.select("doc", "tkey", "digest").distinct().join(held, F.col("doc").eqNullSafe(F.col("d")) & (F.col("tkey") == F.col("t")))
    verdict = rule(F.col("value"), F.col("kind"), F.col("owners"), F.col("repositories"), example_owners)
    added = base.join(ownership(of), "digest").withColumn("verdict", verdict).where("verdict is not null").select(
        "doc", "tkey", F.col("verdict").alias("kind"), F.col("from").alias("start"), (F.col("from") + F.char_length("value")).alias("end")
    ).distinct()
    return rows, base.select("doc", "tkey", "kind", "start", "end").unionByName(added)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
    example_owners: int = 3, rule: Callable[..., Column] = full_verdict,
) -> DataFrame:
    """Base spans per document, and spans that the corpus-wide frequency adds.

    Columns: id_col, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example.
    Every base match stays. Its value is hashed and counted by distinct owners and
    repositories over the corpus, from which `rule` decides whether it is a widely
    copied `example`, a `live` credential, or neither. An added span covers
    the value alone; spans are in code points, end exclusive, sorted by start, then
    kind as in ORDER, then end.

    Null texts count as empty. Null owners and repositories count as one each.
    Repeated rows give one result row each; rows that share an id but not the text
    are told apart by the text's hash. Empty tables give empty results; other
    columns are ignored. Texts are scanned once, in place; matches alone are shuffled.
    """
    rows, spans = judged_spans(docs, id_col, text_col, owner_col, repo_col, example_owners, rule)
    rank = F.array_position(F.array(*[F.lit(k) for k in ORDER]), F.col("kind"))
    per_doc = spans.groupBy("doc", "tkey").agg(
        F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("s")
    )
    count = lambda kind: F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("s", lambda x: x["rank"] <= len(KINDS))
    per_doc = per_doc.select(
        F.col("doc").alias("d"), F.col("tkey").alias("t"), *[count(k).alias(f"n_{k}") for k in ORDER],
        F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("s")).alias("spans"),
    )
    out = rows.select("doc", "tkey").join(per_doc, F.col("doc").eqNullSafe(F.col("d")) & (F.col("tkey") == F.col("t")), "left")
    number = lambda kind: F.coalesce(f"n_{kind}", F.lit(0).cast("long")).alias(f"n_{kind}")
    return out.select(
        F.col("doc").alias(id_col), *[number(k) for k, *_ in KINDS],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), number(LIVE), number(EXAMPLE),
    )


def redact_live(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
    example_owners: int = 3, placeholder: str = PLACEHOLDER,
) -> DataFrame:
    """`docs` with every live credential replaced by the placeholder; all rows and columns stay.

    Overlapping live spans become one. Null texts stay null, rows of one id and text are treated
    alike, and columns may have any names. An empty table stays empty.
    """
    _, spans = judged_spans(docs, id_col, text_col, owner_col, repo_col, example_owners, full_verdict)
    before = Window.partitionBy("doc", "tkey").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    order = Window.partitionBy("doc", "tkey").orderBy("start", "end")
    runs = (
        spans.where(F.col("kind") == LIVE)
        .withColumn("fresh", (F.col("start") >= F.coalesce(F.max("end").over(before), F.lit(0))).cast("int"))
        .withColumn("run", F.sum("fresh").over(order))
        .groupBy("doc", "tkey", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    doc, tkey, cut = (free_name(docs, c) for c in ("_doc", "_tkey", "_cuts"))
    cuts = written(
        runs.groupBy("doc", "tkey").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(cut))
        .select(F.col("doc").alias(doc), F.col("tkey").alias(tkey), cut),
        "redactions",
    )
    text = F.col(text_col).cast("string")
    key = F.xxhash64(F.coalesce(text, F.lit("")))
    marked = docs.join(cuts, F.col(id_col).eqNullSafe(F.col(doc)) & (key == F.col(tkey)), "left")
    last = F.size(cut)
    pieces = F.transform(cut, lambda c, i: F.substring(
        text, F.when(i == 0, 1).otherwise(F.get(cut, i - 1)["end"].cast("int") + 1),
        (c["start"] - F.when(i == 0, 0).otherwise(F.get(cut, i - 1)["end"])).cast("int"),
    ))
    rest = F.substring(text, F.get(cut, last - 1)["end"].cast("int") + 1, F.char_length(text))
    clean = F.concat(F.array_join(pieces, placeholder), F.lit(placeholder), rest)
    return marked.withColumn(text_col, F.when(F.col(cut).isNotNull(), clean).otherwise(F.col(text_col))).select(*docs.columns)
