"""Secret scans through an incremental ledger of blobs.

A blob is a text, named by its SHA-256. The ledger is a table of (blob, rule, version) pairs that were
scanned, each with its findings. A scan takes every version of every path, reduces it to blobs, finds
the pairs that the ledger lacks, reads the text of each such blob once, from one path that has it,
appends what it found, and joins findings back to all paths. Copies and unchanged versions are not
scanned again; a rule with a new version is, alone.

Everything is DataFrame expressions. A rule's matches come from one pass of its pattern; the text
between matches, from splitting by the same pattern, gives their places as running sums of lengths.

Defined results: a null text is the empty text; texts without findings have empty results; rows that
share a path are told apart by their text, equal rows repeat their result; null paths are paths;
other columns are ignored by :func:`scan`, kept by :func:`redact`. Places count code points, ends are
exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm import textops as X
from tidemark.session import scratch_path, settle


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    group: int = 0  # the group whose length is judged
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed patterns, as given. Runs are greedy, so a run that is too short hides no longer one.
RULES = (
    Rule(
        "assign", 1,
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)
LEDGER = "blob binary, todo array<string>, hits array<struct<rule:string,nr:int,gap:int,length:int,good:boolean>>"


def blob_of(text: str):
    return F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))


def _hits(text, rule: Rule):
    """Matches of a rule in order: characters since the last one, own length, and whether they pass."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    zipped = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), whole.alias("match"), judged.alias("judged"))
    found = F.filter(zipped, lambda x: x["match"].isNotNull())
    shown = F.transform(
        found,
        lambda x, i: F.struct(
            F.lit(rule.name).alias("rule"), i.alias("nr"), F.char_length(x["gap"]).alias("gap"),
            F.char_length(x["match"]).alias("length"), (F.char_length(x["judged"]) >= rule.least).alias("good"),
        ),
    )
    none = F.from_json(F.lit("[]"), "array<struct<rule:string,nr:int,gap:int,length:int,good:boolean>>")
    return F.when(text.rlike(rule.pattern), shown).otherwise(none)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at a path; an empty one where nothing was written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def update(versions: DataFrame, ledger_path: str, path: str, text: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks and append it; returns (path, blob) of every version, settled."""
    spark = versions.sparkSession
    ledger = read_ledger(spark, ledger_path)
    keyed = settle(versions.select(F.col(path).alias("path"), blob_of(text).alias("blob")), "secret-blobs")
    names = F.array(*[F.lit(r.name) for r in rules])
    done = ledger.select("blob", F.explode("todo").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    one = keyed.groupBy("blob").agg(F.min("path").alias("path")).join(done, "blob", "left")
    todo = F.array_except(names, F.coalesce("done", F.array().cast("array<string>")))
    one = one.select(F.col("path").alias("from"), F.col("blob").alias("wanted"), todo.alias("todo")).where(F.size("todo") > 0)
    texts = versions.select(F.col(path).alias("path"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    texts = texts.join(one.hint("shuffle_hash"), F.col("path").eqNullSafe(F.col("from")))
    hits = [F.when(F.array_contains("todo", r.name), _hits(F.col("text"), r)) for r in rules]
    scanned = texts.select("wanted", blob_of("text").alias("blob"), "todo", F.flatten(F.array_compact(F.array(*hits))).alias("hits"))
    scanned = scanned.where("blob = wanted").select("blob", "todo", "hits")
    scanned.write.mode("append").parquet(ledger_path)
    return keyed


def findings(spark: SparkSession, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, kind, rank, start, end) of the current rules; what a repeated append stored twice counts once."""
    ledger = read_ledger(spark, ledger_path)
    hits = ledger.where(F.size("hits") > 0).select("blob", F.explode("hits").alias("hit")).select("blob", "hit.*").distinct()
    order = Window.partitionBy("blob", "rule").orderBy("nr")
    end = F.sum(F.col("gap") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = hits.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.col("length")).where("good")
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    kind = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.kind))])
    placed = placed.where(F.col("rule").isin([r.name for r in rules]))
    return placed.select("blob", kind[F.col("rule")].alias("kind"), rank[F.col("rule")].alias("rank"), "start", "end")


def scan(versions: DataFrame, path: str = "doc_id", text: str = "text", ledger_path: str | None = None,
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per version: path and its findings, an array of (start, rank, kind, end) in that order."""
    spark = versions.sparkSession
    ledger_path = ledger_path or scratch_path(spark, "secret-ledger")
    keyed = update(versions, ledger_path, path, text, rules)
    entry = F.struct("start", "rank", "kind", "end")
    per_blob = findings(spark, ledger_path, rules).groupBy("blob").agg(F.array_sort(F.collect_list(entry)).alias("spans"))
    none = F.array().cast("array<struct<start:long,rank:int,kind:string,end:long>>")
    return keyed.join(per_blob, "blob", "left").select("path", F.coalesce("spans", none).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts per kind, and the spans as text and hashed."""
    shown = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(shown, 256).alias("base_sha256"), shown.alias("spans"),
    )


def redact(docs: DataFrame, path: str = "doc_id", text: str = "text", ledger_path: str | None = None,
           rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]", length: str | None = "n_chars") -> DataFrame:
    """The documents with each run of overlapping findings replaced by ``mask``; column ``length``, if there is
    one, is set to the new number of characters of changed texts. Null texts stay null, repeated rows repeat, all
    columns are kept, whatever their names."""
    spark = docs.sparkSession
    ledger_path = ledger_path or scratch_path(spark, "secret-ledger")
    update(docs, ledger_path, path, text, rules)
    found = findings(spark, ledger_path, rules)
    order = Window.partitionBy("blob").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.withColumn("fresh", F.coalesce(F.col("start") >= before, F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("blob", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = runs.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    blob, named = (X.fresh(n, docs.columns) for n in ("__blob", "__cuts"))
    joined = docs.withColumn(blob, blob_of(text)).join(cuts.toDF(blob, named).hint("shuffle_hash"), blob, "left")
    cut, body = F.col(named), F.col(text)
    low = F.concat(F.array(F.lit(0).cast("long")), F.transform(cut, lambda c: c["end"]))
    high = F.concat(F.transform(cut, lambda c: c["start"]), F.array(F.char_length(body).cast("long")))
    kept = F.zip_with(low, high, lambda a, b: body.substr((a + 1).cast("int"), (b - a).cast("int")))
    clean = F.when(cut.isNotNull(), F.array_join(kept, mask)).otherwise(body)
    out = []
    for name in docs.columns:
        if name == text:
            out.append(clean.alias(name))
        elif name == length:
            cut_out = F.aggregate(cut, F.lit(0).cast("long"), lambda n, c: n + c["end"] - c["start"])
            changed = (F.char_length(body) - cut_out + len(mask) * F.size(cut)).cast(docs.schema[name].dataType)
            out.append(F.when(cut.isNotNull(), changed).otherwise(F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return joined.select(*out)
