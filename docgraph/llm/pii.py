"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base spans come from four fixed patterns (email, ip, card, phone), leftmost and non-overlapping per kind. They
and long hexadecimal keys are the seeds. The text left of a seed is its lexical pattern (a word with an optional
sign and quote). Patterns and instances form a bipartite graph: a pattern's score is the share of its instances
that are trusted, an instance's the best score of its patterns; rounds go on until the trusted patterns stay the
same. Identifier-like tokens behind a pattern that ends with `precision` and `support` become further spans. Base spans
always stay.

split() gives what lies between matches and regexp_extract_all() the matches; each match goes on as a row with the length
of the gap before it, and a running sum over the matches of a text gives positions, so that a text is read once for each
kind and a very long one with very many matches takes time in proportion. The patterns are written so that Java's matcher
needs no recursion and no rescan: where a group would repeat, a first replacement of equal length makes one character
class enough. Words, tokens and gaps may have any length.

Null texts are empty. Rows are told apart by their place in the table, not by doc_id: a repeated row, and one with a null
doc_id, is scanned and returned like any other. Ties: spans are ordered by start, then by kind as listed. An empty table
gives no rows. Further columns of any name are kept by redacted() and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

KINDS = ["email", "ip", "card", "phone", "key"]
#: Ranks beside those of KINDS: candidates, and words that may stand before a span.
TOKEN_RANK, WORD_RANK = 4, 5
#: A pattern that ends with a sign or quote is trusted from PRECISION on, a bare word from BARE on.
PRECISION, BARE, SUPPORT = 0.5, 0.9, 3
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+"
CARD = r"(?<![0-9 -])(?=[0-9](?:[ -]?[0-9]){11})[0-9 -]+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
TOKEN = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{6,}+(?!@)"
SEED_KEY = "^[0-9a-f]{32,64}$"
#: A word with sign and quote, directly before something with a digit or an @.
WORD = r"(?U)(?<![\p{L}_])[\p{L}_]{2,}+[ \t]*+[:=#]?+[ \t]*+[\"'(]?+(?=[A-Za-z._%+-]*+[0-9@])"
#: Code points of the pieces in which a text is cut before parts are taken out of it.
BLOCK = 4096


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _found(text: Column, rank: int, pattern: str, when: Column, good=None) -> Column:
    """array<struct<rank, gap, size, good, inst, seed, pat>> of the matches, in order; behind them one of size null."""

    def one(gap, hit):
        return F.struct(
            F.lit(rank).alias("rank"), F.length(gap).alias("gap"), F.length(hit).alias("size"), (good(hit) if good else F.lit(True)).alias("good"), F.xxhash64(hit).alias("inst"),
            (hit.rlike(SEED_KEY) if rank == TOKEN_RANK else F.lit(False)).alias("seed"), (F.lower(hit) if rank == WORD_RANK else F.lit("")).alias("pat"),
        )

    return F.when(when, F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), one))


def matches(docs: DataFrame) -> DataFrame:
    """rid, rank, i, gap, size, good, inst, seed, pat of docs (rid, text): a row for each match; gap is what lies between it and
    the one before."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    t = F.col("text")
    part = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.regexp_extract(p, "([0-9]{1,3})$", 1).cast("int"), F.lit(0)) <= 255)
    found = [
        _found(F.regexp_replace(t, r"\.(?![A-Za-z0-9-])", "_"), 0, EMAIL, t.contains("@")),
        _found(t, 1, IP, t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), lambda h: F.forall(F.split(h, r"\."), part)),
        _found(F.regexp_replace(t, "(?<![0-9])[ -]|[ -](?![0-9])", "x"), 2, CARD, t.rlike("[0-9](?:[ -]?[0-9]){11}"), lambda h: F.length(_digits(h)).between(12, 19) & _luhn(_digits(h))),
        _found(t, 3, PHONE, t.rlike(r"\+[0-9]"), lambda h: F.length(_digits(h)).between(9, 15)),
        _found(t, TOKEN_RANK, TOKEN, t.rlike("[0-9]")),
        _found(t, WORD_RANK, WORD, t.rlike("[0-9@]")),
    ]
    d = docs.select("rid", text.alias("text"))
    each = d.select("rid", F.explode(F.array(*found)).alias("own")).select("rid", F.posexplode("own").alias("i", "m"))
    return each.select("rid", "i", "m.*").where("size is not null")


def scan(docs: DataFrame) -> DataFrame:
    """rid, start, end, rank, inst, pat, seed of the base spans, and of the tokens (TOKEN_RANK) that overlap none of them."""
    m = matches(docs).repartition("rid")
    own = Window.partitionBy("rid", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    m = m.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(own).cast("int")).where("good").withColumn("start", (F.col("end") - F.col("size")).cast("int"))
    word, base = F.col("rank") == WORD_RANK, F.col("rank") < TOKEN_RANK
    # words stand where they end, before what starts there
    m = m.withColumn("at", F.when(word, F.col("end")).otherwise(F.col("start")))
    order = [F.col("at"), (~word).cast("int"), F.col("rank")]
    before = Window.partitionBy("rid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("rid").orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("last", F.last(F.when(word, F.struct("end", "pat")), True).over(before)).withColumn("reach", F.max(F.when(base, F.col("end"))).over(before)).withColumn("next", F.last(F.when(base, F.col("start")), True).over(behind))
    apart = base | ((F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end")))
    pat = F.when(F.col("last.end") == F.col("start"), F.col("last.pat")).otherwise("")
    return m.where(~word & apart).select("rid", "start", "end", "rank", "inst", pat.alias("pat"), "seed")


def bootstrap(scanned: DataFrame, precision: float = PRECISION, support: int = SUPPORT) -> DataFrame:
    """(pat, as_rank) of the patterns that are trusted in the end."""
    known = F.when(F.col("rank") < TOKEN_RANK, F.col("rank")).when(F.col("seed"), KINDS.index("key"))
    graph = common.cut(scanned.where("pat <> ''").groupBy("pat", "inst").agg(F.min(known).alias("rank")), "pii-graph")
    size = common.cut(graph.groupBy("pat").agg(F.count("*").alias("n")), "pii-sizes")
    seeds = graph.where("rank is not null").select("inst", "rank", F.lit(1.0).alias("score")).groupBy("inst", "rank").agg(F.max("score").alias("score"))
    trusted, seen = seeds, []
    while True:
        good = common.join_hot(graph.select("pat", "inst"), trusted, ["inst"], "pat").groupBy("pat", "rank").agg(F.count("*").alias("k"), F.sum("score").alias("s"))
        least = F.when(F.col("pat").rlike("[:=#\"'(]"), precision).otherwise(max(precision, BARE))
        scored = good.join(size, "pat").where(F.col("k") >= support).select("pat", "rank", (F.col("s") / F.col("n")).alias("score")).where(F.col("score") >= least)
        best = scored.groupBy("pat").agg(F.max_by("rank", F.struct("score", -F.col("rank"))).alias("rank"), F.max("score").alias("score"))
        patterns = common.cut(best, "pii-patterns")
        sign = tuple(patterns.agg(F.count("*"), F.bit_xor(F.xxhash64("pat", "rank"))).first())
        if sign in seen:
            return patterns.select("pat", F.col("rank").alias("as_rank"))
        seen.append(sign)
        found = common.join_hot(graph.where("rank is null").select("pat", "inst"), patterns, ["pat"], "inst").groupBy("inst").agg(F.max_by("rank", F.struct("score", -F.col("rank"))).alias("rank"), F.max("score").alias("score"))
        trusted = seeds.union(found)


def _spans(scanned: DataFrame, precision: float, support: int) -> DataFrame:
    """rid, start, rank, end, base of all spans: base ones, long hexadecimal keys, and tokens behind trusted patterns."""
    key = F.lit(KINDS.index("key"))
    sure = scanned.where((F.col("rank") < TOKEN_RANK) | F.col("seed")).select("rid", "start", F.when(F.col("seed"), key).otherwise(F.col("rank")).alias("rank"), "end", (~F.col("seed")).alias("base"))
    tokens = scanned.where((F.col("rank") == TOKEN_RANK) & ~F.col("seed") & (F.col("pat") != "")).select("rid", "start", "end", "pat")
    more = common.join_hot(tokens, bootstrap(scanned, precision, support), ["pat"], "rid").select("rid", "start", F.col("as_rank").alias("rank"), "end", F.lit(False).alias("base"))
    return sure.union(more)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["rank"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def extract(docs: DataFrame, precision: float = PRECISION, support: int = SUPPORT) -> DataFrame:
    """rid, doc_id, base and spans (arrays of start, rank, end, base) for every row of docs (doc_id, text)."""
    docs = common.numbered(docs.select("doc_id", "text"))
    spans = _spans(common.cut(scan(docs), "pii-scan"), precision, support)
    each = spans.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end", "base"))).alias("all"))  # of one text
    rows = docs.select("rid", "doc_id").join(each, "rid", "left")
    all_ = F.coalesce("all", F.array().cast("array<struct<start:int,rank:int,end:int,base:boolean>>"))
    return rows.select("rid", "doc_id", F.filter(all_, lambda x: x["base"]).alias("base"), all_.alias("spans"))


def redact(text: Column, runs: Column) -> Column:
    """The text with each run (start, rank, end), which are sorted and apart, replaced by the mark of its kind, such as <EMAIL>."""
    mark = lambda rank: F.element_at(F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS]), rank + 1)
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def piece(blocks: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / BLOCK).cast("int")
        return F.substring(F.array_join(F.slice(blocks, first + 1, F.floor(b / BLOCK).cast("int") - first + 1), ""), a - first * BLOCK + 1, b - a)

    def whole(blocks: Column) -> Column:
        end = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.element_at(runs, F.greatest(k, F.lit(1)))["end"])
        marked = F.transform(runs, lambda r, k: F.concat(piece(blocks, end(k), r["start"]), mark(r["rank"])))
        return F.concat(F.array_join(marked, ""), piece(blocks, end(F.size(runs)), F.length(text)))

    # the blocks are made once: a list of one element is transformed
    return F.when(F.coalesce(F.size(runs), F.lit(0)) <= 0, text).otherwise(F.element_at(F.transform(F.array(blocks), whole), 1))


def redacted(docs: DataFrame, precision: float = PRECISION, support: int = SUPPORT) -> DataFrame:
    """The rows of docs with all personal data in their texts marked; null texts stay null.

    Spans that overlap are one run, which has the mark of the first one.
    """
    rid, run = common.free_name(docs, "rid"), common.free_name(docs, "runs")
    rows = common.numbered(docs, rid)
    spans = _spans(common.cut(scan(rows.select(F.col(rid).alias("rid"), "text")), "pii-scan"), precision, support)
    before = Window.partitionBy("rid").orderBy("start", "rank", "end").rowsBetween(Window.unboundedPreceding, -1)
    to_here = Window.partitionBy("rid").orderBy("start", "rank", "end").rowsBetween(Window.unboundedPreceding, 0)
    new = spans.withColumn("new", (F.coalesce(F.max("end").over(before), F.lit(0)) <= F.col("start")).cast("int"))
    runs = new.withColumn("run", F.sum("new").over(to_here)).groupBy("rid", "run").agg(F.min(F.struct("start", "rank")).alias("first"), F.max("end").alias("end"))
    runs = runs.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("first.start", "first.rank", "end"))).alias("runs"))  # of one text
    rows = rows.join(runs.toDF(rid, run), rid, "left")
    text = docs.columns.index("text")
    return rows.select(*[redact(F.col("text"), F.col(run)).alias("text") if i == text else F.col(f"`{c}`") for i, c in enumerate(docs.columns)])


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda i: F.size(F.filter("base", lambda s: s["rank"] == i)).cast("long").alias(f"n_{KINDS[i]}")
    return found.select("doc_id", *[n(i) for i in range(4)], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
