"""Secret scan with multipart credential linking, in DataFrame operations only.

Three base patterns (assignments to secret names, access keys, hex strings)
are reported wherever they match. A credential often comes in parts that look
harmless alone: an identifier, a random string, an endpoint. Such weak
candidates are reported only where complementary parts co-occur: a secret near
an identifier or an endpoint, within one scope (a block of text between blank
lines) and at most ``reach`` code points apart. Parts meet by an interval join
on the stretches of ``reach`` code points that they touch, so the work is
bounded by the number of parts, however many a text holds.

A text is split by each pattern; the pieces' and the matches' lengths, summed
up, give places in code points. Only those lengths are shuffled, never texts.

Defined results
* Each base kind is matched leftmost and non-overlapping over the whole text;
  matches that are too short are dropped after matching.
* Weak candidates come from one such scan, in which base matches use up their
  text too: so a candidate never starts inside a base match. They don't change base spans.
* Spans are sorted by start, then by kind in the order of ``KINDS``.
* A null text is empty. Texts without findings have zero counts and empty lists.
* One row per input row: rows that repeat each other (ids too) each get theirs.
* An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import materialize

REACH = 200


def any_case(words: str) -> str:
    """A pattern with each letter in either case, written out: what "ignore case" takes for a letter's cases differs between engines."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in words)


def _assigned(names: str, value: str) -> str:
    """``name = "value"`` and its like."""
    return f"(?:{any_case(names)})[\"']?\\x20*[:=]\\x20*[\"']?({value})"


ASSIGN = _assigned("password|passwd|secret|token|api_?key", "[A-Za-z0-9+/_.=-]+")
ACCESS = "AKIA[A-Z0-9]{16,}"  # 20 characters or more: a match takes all that follow, so shorter ones needn't be dropped after
HEX = "[0-9a-f]{24,}"
IDENTIFIER = _assigned("access_?key_?id|access_?key|client_?id|account_?id|key_?id|user_?name|login", "[A-Za-z0-9@._+-]{4,}")
ENDPOINT = ("(?:https?|wss?|s?ftp|ssh|s3|amqps?|redis|mongodb|mysql|postgres(?:ql)?)://[^\\x20\\x09-\\x0D\"'<>]+|"
            + _assigned("endpoint|host_?name|host|server|base_?url", "[A-Za-z0-9._:/-]{4,}"))
RANDOM = "[A-Za-z0-9+/_-]{20,}"  # a weak secret if it has digits and letters of both cases
BREAK = "\\n[\\x20\\x09\\x0D]*\\n"
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "identifier", "endpoint", "secret")
# what the scan for weak candidates takes, the first that matches at a place; base matches are used up
WEAK = (("used", ASSIGN), ("used", ACCESS), ("endpoint", ENDPOINT), ("identifier", IDENTIFIER), ("random", RANDOM), ("break", BREAK))


def _weak_kind(found: Column) -> Column:
    """Kind of a match of the scan for weak candidates: that of the first alternative it starts with."""
    kind = F.lit(None)
    for name, pattern in reversed(WEAK):
        value = F.lit(None if name == "used" else name)
        if name == "random":
            value = F.when(found.rlike("[0-9]") & found.rlike("[a-z]") & found.rlike("[A-Z]"), "secret")
        kind = F.when(found.rlike(f"^(?:{pattern})"), value).otherwise(kind)
    return kind


SCANS = {
    "assign": (ASSIGN, lambda m: F.when(F.char_length(F.regexp_extract(m, ASSIGN, 1)) >= 6, "assign")),
    "access": (ACCESS, lambda m: F.lit("access")),
    "hex": (HEX, lambda m: F.lit("hex")),
    "weak": ("|".join(f"(?:{pattern})" for _, pattern in WEAK), _weak_kind),
}


def _matches(scan: str) -> Column:
    """Length and kind of each match in the column named like the scan."""
    return F.transform(scan, lambda m: F.struct(F.char_length(m).alias("len"), SCANS[scan][1](m).alias("kind")))


def _hits(scan: str) -> Column:
    """The scan's matches with the lengths of the pieces of text before them; the piece after the last match goes."""
    gaps = F.when(F.size(scan) > 0, F.transform(F.split("text", SCANS[scan][0], -1), F.char_length))
    zipped = F.zip_with(scan, gaps, lambda m, gap: F.struct(
        F.lit(scan).alias("scan"), gap.alias("gap"), m["len"].alias("len"), m["kind"].alias("kind")))
    return F.filter(zipped, lambda x: x["len"].isNotNull())


def _lengths(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row of ``docs``: ``uid``, ``doc_id`` and ``hits``, per match of each
    scan, in order, the lengths of the text since the match before and of the match, and its kind (null: dropped)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("*", *(F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(name) for name, (p, _) in SCANS.items()))
    rows = rows.select("doc_id", "text", *(_matches(name).alias(name) for name in SCANS))
    # the scan for weak candidates matters only if it found one; breaks alone say nothing
    rows = rows.withColumn("weak", F.when(F.exists("weak", lambda m: m["kind"].isin(*KINDS)), F.col("weak")))
    hits = [F.coalesce(_hits(name), F.array()) for name in SCANS]
    return materialize(rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.concat(*hits).alias("hits")), "secret-lengths")


def _parts(lengths: DataFrame) -> DataFrame:
    """One row per base match and weak candidate: ``uid, kind, start, end, scope``."""
    hits = (lengths.where(F.size("hits") > 0).select("uid", F.posexplode("hits").alias("i", "h"))
            .select("uid", "i", "h.*").repartition("uid"))  # both windows use this one exchange
    along = Window.partitionBy("uid", "scan").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (hits.withColumn("end", F.sum((F.col("gap") + F.col("len")).cast("long")).over(along))
              .withColumn("start", F.col("end") - F.col("len")).where("kind IS NOT NULL"))
    before = Window.partitionBy("uid").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scoped = placed.withColumn("scope", F.sum(F.when(F.col("kind") == "break", 1).otherwise(0)).over(before))
    return materialize(scoped.where("kind <> 'break'").select("uid", "kind", "start", "end", "scope"), "secret-parts")


def _near(parts: DataFrame, others: DataFrame, reach: int) -> DataFrame:
    """The ``parts`` with one of ``others`` in their scope at most ``reach``
    away: an interval join on the stretches of ``reach`` code points that both touch."""
    def stretches(lo: Column, hi: Column) -> Column:
        return F.explode(F.sequence(F.floor(lo / reach), F.floor(hi / reach)))

    keys = ["uid", "scope", "stretch"]
    wide = parts.withColumn("stretch", stretches(F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach))
    there = others.select("uid", "scope", F.col("start").alias("o_start"), F.col("end").alias("o_end"), stretches(F.col("start"), F.col("end")).alias("stretch"))
    a, b = wide.alias("a"), there.alias("b")
    meet = reduce(Column.__and__, (F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys))
    return (a.join(b, meet & (F.col("b.o_start") <= F.col("a.end") + reach) & (F.col("b.o_end") + reach >= F.col("a.start")), "left_semi")
            .select(*parts.columns).distinct())  # a part may meet another in several stretches


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """``doc_id`` and ``findings`` (array of start, end, kind) per row of ``docs``."""
    lengths = _lengths(docs, id_col, text_col)
    parts = _parts(lengths)
    base = parts.where(F.col("kind").isin(*BASE))
    weak = parts.where(~F.col("kind").isin(*BASE))
    secrets, others = F.col("kind").isin("assign", "hex", "secret"), F.col("kind").isin("access", "identifier", "endpoint")
    found = (base.unionByName(_near(weak.where(secrets), parts.where(others), reach))
             .unionByName(_near(weak.where(others), parts.where(secrets), reach)))
    rank = reduce(lambda c, i: F.when(F.col("kind") == KINDS[i], i).otherwise(c), range(len(KINDS)), F.lit(len(KINDS)))
    lists = found.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("sorted"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")
    findings = F.transform("sorted", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    return lengths.select("uid", "doc_id").join(lists, "uid", "left").select("doc_id", F.coalesce(findings, empty).alias("findings"))


def listed(findings: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
