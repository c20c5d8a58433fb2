"""Filter interaction audit: what each filter of a chain removes, in every order of the chain, DataFrame functions only.

Five filters judge each text: too few words, too little variety, too many capitals, odd characters, and a copy of a text of a
smaller id.  What a text fails doesn't depend on the order, so rows are first counted by what they fail: a *mask cell*.  Each cell then
folds across the array of all 120 orders, which goes with the plan to every task: ``aggregate`` walks an order's steps with the
flag of what is gone already, ``transform`` does so for all orders, and the 600 structs, weighted by the cell's counts, are merged
by sums element by element.  The fold's work grows with the cells, 32 at most in a part, not with the rows.

A copy is found by digests: rows are counted map-side by digest, part and labels, so that a text that a third of all rows have is a
few rows before anything compares ids.

Defined cases: a null text counts as empty; a null language is the part ``''``; a null id is smaller than none and has none
that is smaller, and has no label; rows that repeat an id count each, and those of the smallest id of a text aren't copies; of several labels of an id
any that says 1 counts; labels of unknown ids don't matter; an empty table gives no rows; columns that aren't named don't matter.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import read

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
LEAST_WORDS, VARIETY, CAPITALS, ODD = 100, 80, 10, "[#$%&*|]"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def failed(text: Column) -> Column:
    """The letters of the filters that a text fails by itself."""
    words = F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " "), "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = {
        "A": F.size(words) < LEAST_WORDS, "B": 100 * F.size(F.array_distinct(words)).cast("long") < VARIETY * F.size(words).cast("long"),
        "C": 100 * capitals.cast("long") > CAPITALS * F.length(text).cast("long"), "D": text.rlike(ODD),
    }
    return F.concat(*[F.when(c, k).otherwise("") for k, c in fails.items()])


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``(part, failed, n, good, toxic)``: rows of each part by the filters they fail."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), failed(text).alias("failed"), F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part"))
    says = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("string").alias("key")).agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    # Rows without an id go by their digests: one key must not gather them.
    rows = rows.withColumn("key", F.coalesce(F.col("id").cast("string"), F.hex("digest")))
    marked = rows.join(known, (rows["key"] == known["key"]) & F.col("id").isNotNull(), "left").select("id", "digest", "failed", "part", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    group = ["digest", "failed", "part", "good", "toxic"]
    each = marked.groupBy(*group, "id").agg(F.count("*").alias("n"))
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    groups = each.groupBy(*group).agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col("n"))), F.lit(0)).alias("with_id"), least.alias("least"))
    groups = groups.withColumn("first", F.min("least.id").over(Window.partitionBy("digest")))
    copies = F.col("with_id") - F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    both = F.inline(F.array(F.struct(F.col("failed"), (F.col("n") - copies).alias("m")), F.struct(F.concat("failed", F.lit("E")).alias("failed"), copies.alias("m"))))
    told = groups.select("part", "good", "toxic", both).where("m > 0")
    return told.groupBy("part", "failed").agg(F.sum("m").alias("n"), F.sum(F.col("m") * F.col("good")).alias("good"), F.sum(F.col("m") * F.col("toxic")).alias("toxic"))


def folded(orders: Column) -> Column:
    """A cell's 600 weighted structs: its fold along each of the orders."""

    def step(state: Column, i: Column, order: Column) -> Column:
        letter = F.substr(order, i, F.lit(1))
        fails, gone = F.contains(F.col("failed"), letter), state["gone"]
        here = fails & ~gone
        of = lambda c, n="n": F.when(c, F.col(n)).otherwise(F.lit(0).cast("long"))
        made = F.struct(
            order.alias("filter_order"), i.alias("step"), of(~fails & ~gone).alias("kept"), of(here).alias("removed"), of(fails & gone).alias("redundant"),
            of(F.col("failed") == letter).alias("unique_fails"), of(here, "good").alias("good_lost"), of(here, "toxic").alias("toxic_lost"),
        )
        return F.struct((gone | fails).alias("gone"), F.concat(state["out"], F.array(made)).alias("out"))

    kind = "array<struct<filter_order:string,step:int," + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(kind).alias("out"))
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(steps, start, lambda s, i: step(s, i, order), lambda s: s["out"])))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``, zeros included."""
    each = cells(docs, labels, id_col, text_col, part_col).select("part", F.inline(folded(F.lit(ORDERS))))
    sums = each.groupBy("part", "filter_order", "step").agg(*[F.sum(c).alias(c) for c in COUNTS])
    own = F.substr(F.col("filter_order"), F.col("step"), F.lit(1))
    return sums.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", own)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


SQL = r"""
with l as (select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as toxic from labels group by 1),
d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, coalesce(lang, '') as part from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words, min(doc_id) over (partition by t) as first_id from d),
f as (
  select r, part, coalesce(good, false) as good, coalesce(toxic, false) as toxic, unnest(['A', 'B', 'C', 'D', 'E']) as letter,
         unnest([len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
                 regexp_matches(t, '[#$%&*|]'), coalesce(w.doc_id > first_id, false)]) as fails
  from w left join l on l.doc_id = w.doc_id
),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as c),
o as (select a.c || b.c || c.c || d.c || e.c as filter_order from x a, x b, x c, x d, x e where len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s as (select filter_order, cast(i as integer) as step, filter_order[i] as letter from o, range(1, 6) t(i)),
g as (select filter_order, r, min(step) as gone from s join f using (letter) where fails group by 1, 2),
u as (select r, count(*) as n from f where fails group by 1),
j as (
  select f.part, s.filter_order, s.step, s.letter, f.good, f.toxic, f.fails, coalesce(g.gone, 9) as gone, coalesce(u.n, 0) as n
  from s join f using (letter) left join g on g.filter_order = s.filter_order and g.r = f.r left join u on u.r = f.r
),
t as (
  select part, filter_order, step, letter, count(*) filter (gone > step) as kept, count(*) filter (gone = step) as removed, count(*) filter (fails and gone < step) as redundant,
         count(*) filter (fails and n = 1) as unique_fails, count(*) filter (gone = step and good) as good_lost, count(*) filter (gone = step and toxic) as toxic_lost
  from j group by 1, 2, 3, 4
)
select * exclude (letter), cast(sum(removed) over (partition by part, letter) as bigint) as shapley from t
"""

QUERIES = {"op13_filter_audit": query}
ORACLE = {"op13_filter_audit": SQL}
