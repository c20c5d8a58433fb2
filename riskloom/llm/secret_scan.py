r"""Secret scans with multipart credential linking, DataFrame functions only.

Strong findings stand alone: assignments of passwords and tokens, access identifiers and hexadecimal strings (``STRONG``).  Weak
candidates (``WEAK``: names of accounts, values of shorter keywords, long mixed strings and endpoints) say little by themselves.  Each part of a
credential is an identifier, a secret or an endpoint, and a weak candidate is reported only where what complements it starts within
``REACH`` code points of its own start in the same scope, a stretch of text without a blank line: a secret for an identifier, an
identifier for a secret, both for an endpoint.  Strong findings count as complements; weak ones do, too.

A match's place is told by the lengths of the pieces between matches, so positions are running sums over narrow rows
(row, kind, number of the match); texts are read once and never shuffled.  The link is an interval join: a part belongs to the bin of its start,
a candidate looks into its own and both neighbouring bins of REACH code points, and the join asks only whether a
complement is there, so no pairs come out of it.

Defined cases: a null text counts as empty; letters have either case in ASCII only; matches of one kind are leftmost and don't overlap, and
those too short are dropped after matching; a weak candidate that overlaps a strong finding is that finding and isn't
reported again; spans are in code points, the end exclusive; rows that repeat an id, or have none, are scanned each; an
empty table gives no rows; columns that aren't named don't matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import read, stage

#: Code points between the starts of parts that belong together, and the width of a bin.
REACH = 400


def either(words: str) -> str:
    """A pattern whose ASCII letters match in either case, in any engine."""
    return "".join(f"[{c.upper()}{c}]" if "a" <= c <= "z" else c for c in words)


def assigned(words: str, value: str) -> str:
    return f"({either(words)})[\"']?\\x20*[:=]\\x20*[\"']?({value})"


VALUE = "[A-Za-z0-9+/_.=-]"
STRONG = {"assign": assigned("password|passwd|secret|token|api_?key", f"{VALUE}+"), "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
WEAK = {
    "weak_id": assigned("user_?name|user_?id|user|login|client_?id|access_?key_?id|account", "[A-Za-z0-9@._+-]{3,}"),
    "weak_pass": assigned("passphrase|pass|pwd|auth|private_?key|access_?key", f"{VALUE}{{4,}}"),
    "weak_token": "[A-Za-z0-9+/_=-]{32,}",
    "endpoint": "[A-Za-z][A-Za-z0-9+.-]{0,15}://[^\\x00-\\x20\"'<>]+",
}
BREAK = "\\n[\\x20\\t\\r]*\\n"
KINDS = [*STRONG, *WEAK]
IDENTIFIERS, SECRETS, ENDPOINTS = ("access", "weak_id"), ("assign", "hex", "weak_pass", "weak_token"), ("endpoint",)
#: Length of an assignment's value from which on it counts.
LEAST_VALUE = 6


def found(text: Column, kind: int, pattern: str, possible: Column, counts: Callable[[Column], Column] | None = None) -> Column:
    """``array<struct<kind, at, gap, size, counts>>``: each match with its number, its length and what lies between it and the one before.

    The last element stands for the piece after all matches and has no size.
    """
    both = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda piece, match: F.struct(F.length(piece).alias("gap"), F.length(match).alias("size"), (counts(match) if counts else F.lit(True)).alias("counts")),
    )
    numbered = F.transform(both, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), x["gap"].alias("gap"), x["size"].alias("size"), x["counts"].alias("counts")))
    return F.coalesce(F.when(possible, numbered), F.array().cast("array<struct<kind:int,at:int,gap:int,size:int,counts:boolean>>"))


def matches(text: Column) -> Column:
    """All matches in a text, strong, weak and blank lines; quick tests spare most texts most patterns."""
    low = F.lower(text)
    has = lambda *words: F.greatest(F.lit(False), F.lit(False), *[F.contains(low, F.lit(w)) for w in words])
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")
    possible = {
        "assign": has("password", "passwd", "secret", "token", "apikey", "api_key"), "access": F.contains(text, F.lit("AKIA")), "hex": text.rlike(STRONG["hex"]),
        "weak_id": has("user", "login", "client", "access", "account"), "weak_pass": has("pass", "pwd", "auth", "key"), "weak_token": text.rlike(WEAK["weak_token"]),
        "endpoint": F.contains(text, F.lit("://")),
    }
    counts = {"assign": lambda m: F.length(F.regexp_extract(m, STRONG["assign"], 2)) >= LEAST_VALUE, "weak_token": mixed}
    kinds = {k: found(text, i, (STRONG | WEAK)[k], possible[k], counts.get(k)) for i, k in enumerate(KINDS)}
    every = F.concat(*kinds.values())
    # Scopes matter only where there is something weak.
    scoped = F.greatest(*[possible[k] for k in WEAK])
    return F.concat(every, found(text, len(KINDS), BREAK, scoped & F.contains(text, F.lit("\n"))))


def parts(rows: DataFrame) -> DataFrame:
    """``(row_no, scope, kind, start, end)`` of strong findings and of weak candidates beside them."""
    one = rows.where(F.size("found") > 0).select("row_no", F.inline("found")).repartition("row_no")
    after = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(Window.partitionBy("row_no", "kind").orderBy("at"))
    one = one.withColumn("end", after).where("size is not null and counts").withColumn("start", F.col("end") - F.col("size"))
    w = Window.partitionBy("row_no").orderBy("start", "kind")
    strong = F.col("kind") < len(STRONG)
    one = one.withColumns({
        "scope": F.sum((F.col("kind") == len(KINDS)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "held": F.max(F.when(strong, F.col("end"))).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "next": F.expr(f"lead(if(kind < {len(STRONG)}, start, null), 1) ignore nulls over (partition by row_no order by start, kind)"),
    })
    overlaps = F.coalesce(F.col("held") > F.col("start"), F.lit(False)) | F.coalesce(F.col("next") < F.col("end"), F.lit(False))
    return one.where((F.col("kind") < len(KINDS)) & (strong | ~overlaps)).select("row_no", "scope", "kind", "start", "end")


def linked(every: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak candidates of ``parts`` whose complements are all within reach in their scope: an interval semi-join by bins."""
    code = {k: i for i, k in enumerate(KINDS)}
    part = F.when(F.col("kind").isin([code[k] for k in IDENTIFIERS]), "identifier").when(F.col("kind").isin([code[k] for k in SECRETS]), "secret").otherwise("endpoint")
    needs = F.when(part == "identifier", F.array(F.lit("secret"))).when(part == "secret", F.array(F.lit("identifier"))).otherwise(F.array(F.lit("identifier"), F.lit("secret")))
    own = (F.col("start") / reach).cast("long")
    there = every.where(part != "endpoint").select(F.col("row_no").alias("r"), F.col("scope").alias("s"), part.alias("part"), F.col("start").alias("place"), own.alias("b"))
    wanted = every.where(F.col("kind") >= len(STRONG)).select("*", F.size(needs).alias("n"), F.explode(needs).alias("need"))
    wanted = wanted.select("*", F.explode(F.array(own - 1, own, own + 1)).alias("bin"))
    on = [F.col("row_no") == F.col("r"), F.col("scope") == F.col("s"), F.col("need") == F.col("part"), F.col("bin") == F.col("b"), F.abs(F.col("start") - F.col("place")) <= reach]
    hits = wanted.join(there, on, "left_semi").groupBy("row_no", "kind", "start", "end", "n").agg(F.countDistinct("need").alias("met"))
    return hits.where("met = n").select("row_no", "kind", "start", "end")


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """``(id, spans)`` of every row: ``array<struct<kind, start, end>>`` of strong findings and linked weak ones, in the order of
    their starts, then of their kinds."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = stage(docs.select(F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row_no"), matches(text).alias("found")), "secrets")
    every = parts(rows)
    kept = every.where(F.col("kind") < len(STRONG)).select("row_no", "kind", "start", "end").unionByName(linked(every, reach))
    names = F.array(*[F.lit(k) for k in KINDS])
    # A group is one text's findings.
    spans = kept.groupBy("row_no").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    named = F.transform("spans", lambda x: F.struct(F.get(names, x["kind"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    some = rows.where(F.size("found") > 0).select("id", "row_no").join(spans, "row_no", "left").select("id", F.coalesce(named, none).alias("spans"))
    return rows.where(F.size("found") == 0).select("id", none.alias("spans")).unionByName(some)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    show = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"].isin(list(STRONG)))
    return secrets(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), *[count(k) for k in STRONG], F.sha2(show(base).cast("binary"), 256).alias("base_sha256"), show(F.col("spans")).alias("spans")
    )


def _sql() -> str:
    quoted = {k: p.replace("'", "''") for k, p in (STRONG | WEAK | {"break": BREAK}).items()}
    kinds = " union all ".join(
        f"select r, {i} as kind, generate_subscripts(regexp_split_to_array(t, '{p}'), 1) as i, unnest(regexp_split_to_array(t, '{p}')) as piece, unnest(regexp_extract_all(t, '{p}')) as m from d"
        for i, (k, p) in enumerate(quoted.items())
    )
    name = "case kind " + " ".join(f"when {i} then '{k}'" for i, k in enumerate(KINDS)) + " end"
    part = "case when kind in (1, 3) then 'identifier' when kind = 6 then 'endpoint' else 'secret' end"
    near = lambda what: f"exists (select 1 from p q where q.r = p.r and q.scope = p.scope and q.part = '{what}' and abs(q.start_ - p.start_) <= {REACH})"
    return f"""
with d as (select doc_id, coalesce(text, '') as t, row_number() over () as r from documents),
m as materialized ({kinds}),
placed as (select *, sum(length(piece) + coalesce(length(m), 0)) over (partition by r, kind order by i) as end_ from m),
kept as (
  select r, kind, end_ - length(m) as start_, end_ from placed
  where m is not null and (kind <> 0 or length(regexp_extract(m, '{quoted["assign"]}', 2)) >= {LEAST_VALUE})
    and (kind <> 5 or (regexp_matches(m, '[0-9]') and regexp_matches(m, '[A-Z]') and regexp_matches(m, '[a-z]')))
),
p as materialized (
  select k.*, {part} as part, (select count(*) from kept b where b.kind = 7 and b.r = k.r and b.start_ < k.start_) as scope
  from kept k where kind < 3 or (kind < 7 and not exists (select 1 from kept s where s.r = k.r and s.kind < 3 and s.start_ < k.end_ and k.start_ < s.end_))
),
s as (
  select r, kind, start_, concat({name}, ':', start_, ':', end_) as span from p
  where kind < 3 or (part = 'identifier' and {near("secret")}) or (part = 'secret' and {near("identifier")}) or (part = 'endpoint' and {near("identifier")} and {near("secret")})
)
select any_value(doc_id) as doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
       sha256(coalesce(string_agg(span, ',' order by start_, kind) filter (kind < 3), '')) as base_sha256, coalesce(string_agg(span, ',' order by start_, kind), '') as spans
from d left join s using (r) group by r
"""


QUERIES = {"op11_secret_scan": query}
ORACLE = {"op11_secret_scan": _sql()}
