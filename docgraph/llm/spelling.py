"""Spelling variant grouping by pairless wildcard groups, in DataFrame functions.

Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. Two words are near if they differ by one
replaced, inserted or deleted code point. No pair of words is made:

* Replacements. A word of k code points is a member of k groups (position, prefix, suffix): all words that differ at this
  place alone. A group keeps its size and its two most frequent words. Of a member, all others are near; the most frequent
  of them is the first of the two, or the second if the member is the first itself. A group has one word for each letter
  of the alphabet at most, so none is large, however many words there are.
* Deletions and insertions. The distinct words that are left by taking one code point out are looked up in the vocabulary:
  one row for each one found, at most k for a word. It counts for the longer word and for the shorter one.

Both are keyed by what is left without the code point, so one exchange by this key serves them. What a word gathers is summed:
how many words are near (no pair is met twice: one of different place or length is another pair), and the best of them. Its form
is that best word, the smallest of equally frequent ones, if it is `ratio` times as frequent as the word itself. Forms are
followed to the last one by doubling; frequency grows tenfold with each step, so few rounds suffice.

Occurrences are counted before anything is exchanged by word, so that a very common one costs a partition one row. Keys of
words longer than LONG code points are their digests; such a word of k code points takes time in proportion to k * k.

Null and empty texts have no words. Very long texts are read whole. Repeated rows count again each. A null doc_id is an empty one
where the test misspellings of the query are drawn. An empty table gives no rows, and so does one without words that are
frequent enough. Other columns, of whatever name, are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LEAST_LENGTH, LEAST, RATIO, LONG = 7, 2, 10, 48
RUN = "[A-Za-zÀ-ÿ]"


def lowered(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def misspelled(doc_id: Column, word: Column, every: int = 31) -> Column:
    """The word, or in one of `every` cases, by a hash of row and word, without one of its code points."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least: int = LEAST, drawn: bool = False) -> DataFrame:
    """word and n of the words of docs (doc_id, text) that are long and frequent enough; drawn: misspelled() first."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"{RUN}{{{least_length},}}"), F.lit(0))).alias("run"))
    run = runs.select("doc_id", lowered(F.col("run")).alias("run"))
    words = run.select((misspelled(F.col("doc_id"), F.col("run")) if drawn else F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _key(left: Column) -> Column:
    """What is left of a word, or its digest, which no word can equal, if it is long."""
    return F.when(F.length(left) <= LONG, left).otherwise(F.concat(F.lit("#"), F.sha2(left.cast("binary"), 256)))


def near(words: DataFrame) -> DataFrame:
    """word, n_near and best (struct of -n and word) of the words (word, n) that have near ones."""
    place = F.explode(F.sequence(F.lit(1), F.length("word"))).alias("i")
    cut = words.select("word", "n", place).select("i", _key(F.concat(F.substring("word", F.lit(1), F.col("i") - 1), F.substring("word", F.col("i") + 1, F.length("word")))).alias("left"), F.struct((-F.col("n")).alias("m"), "word").alias("w"))
    cut = cut.repartition("left")
    # replacements: a group tells each of its members how many others there are, and the best one
    group = cut.groupBy("left", "i").agg(F.count("*").alias("size"), F.array_sort(F.collect_list("w")).alias("members")).where("size > 1")
    told = group.select((F.col("size") - 1).alias("k"), F.col("members")[0].alias("first"), F.col("members")[1].alias("second"), F.explode("members").alias("w"))
    replaced = told.select("w.word", "k", F.when(F.col("w.word") == F.col("first.word"), F.col("second")).otherwise(F.col("first")).alias("best"))
    # deletions and insertions: a doubled letter can be taken out at two places, which leave one word
    there = words.select(_key(F.col("word")).alias("left"), F.struct((-F.col("n")).alias("m"), "word").alias("shorter"))
    met = cut.groupBy("left", "w").agg(F.lit(1).alias("one")).join(there, "left")
    both = met.select(F.explode(F.array(F.struct(F.col("w").alias("of"), F.col("shorter").alias("best")), F.struct(F.col("shorter").alias("of"), F.col("w").alias("best")))).alias("x"))
    moved = both.select(F.col("x.of.word").alias("word"), F.lit(1).cast("long").alias("k"), F.col("x.best").alias("best"))
    return replaced.union(moved).groupBy("word").agg(F.sum("k").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root of forms (word, form): forms are followed, twice as far each round, until none leads on."""
    at = common.cut(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = common.cut(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        common.forget(at.sparkSession, at)
        at = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return at


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for words (word, n)."""
    words = common.cut(words, "spelling-words")
    found = words.join(near(words), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), (-F.col("best.m")).alias("b"), F.col("best.word").alias("form"))
    is_form = F.col("b") >= ratio * F.col("n")
    found = common.cut(found.select("word", "n", "n_near", F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("b")).alias("form_n")), "spelling-near")
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(common.table(spark, sf_dir, "documents").select("doc_id", "text"), drawn=True))


SQL = r"""
WITH RECURSIVE bits AS (
  SELECT list(list_reduce(list_concat([i::BIGINT], range(8)), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) ORDER BY i) AS crc FROM range(256) AS r(i)
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents
), each AS (
  SELECT doc_id, w, count(*) AS k, coalesce(doc_id::VARCHAR, '') || ':' || w AS s FROM runs WHERE length(w) >= 7 GROUP BY ALL
), bytes AS (
  SELECT w, k, s, hex(encode(s)) AS x FROM each
), hashed AS (
  SELECT w, k, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], [('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT FOR i IN range(len(x) // 2)]), lambda c, b: xor(c // 256, crc[xor(c % 256, b) + 1]))) AS h FROM bytes, bits
), drawn AS (
  SELECT CASE WHEN h % 31 = 0 THEN w[1 : h % length(w)] || w[h % length(w) + 2 : length(w)] ELSE w END AS word, k FROM hashed
), v AS (
  SELECT word, sum(k)::BIGINT AS n FROM drawn WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), cut AS (
  SELECT word, n, i, word[1 : i - 1] || word[i + 1 : length(word)] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
), pairs AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS m, arg_min(other, (-n, encode(other))) AS other FROM pairs GROUP BY word
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 10 * v.n THEN other END AS form, CASE WHEN m >= 10 * v.n THEN m END AS form_n FROM v LEFT JOIN best ON v.word = best.word
), walk AS (
  SELECT word, word AS node FROM forms UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.node WHERE f.form IS NOT NULL
), ends AS (
  SELECT walk.word, node AS root FROM walk JOIN forms f ON f.word = node WHERE f.form IS NULL
)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e ON e.word = f.word
"""
