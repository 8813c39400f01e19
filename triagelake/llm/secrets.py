"""Secret scanning with linking of credentials that come in several parts.

Base spans: assignments to a secret's name, access identifiers and long hexadecimal runs.
Weak candidates (a bare 40-character secret, an endpoint address, a temporary access
identifier) say little alone. They are joined with the parts that complement them when both
lie within ``SCOPE`` code points of each other in one document: every part is entered in the
scope-sized buckets it reaches, parts meet by bucket, the exact distance decides. A secret is
reported beside an access identifier, a temporary identifier beside a secret, an endpoint
beside an identifier and a secret.
Since a bucket holds at most ``SCOPE`` characters, the pairs of a bucket are bounded.

Cases: null text is empty; documents without spans have zero counts and empty lists; rows that
repeat a document share its result; a linked secret that is also the value of an assignment is
listed as both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import places

SCOPE = 300
# ---- fixed values: patterns of the contract ----
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # runs are maximal, so shorter ones need not be matched and dropped
SHORTEST_VALUE, SHORTEST_ACCESS = 6, 20
# ---- weak parts ----
BARE_SECRET = r"(?<![A-Za-z0-9/+])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])"
TEMPORARY = r"(?<![A-Z0-9])ASIA[A-Z0-9]{16}(?![A-Z0-9])"
# Single character classes only: a repeated group needs stack for each repetition.
ENDPOINT = r"""(?i)\b(?:https?|s3)://[^\s"'<>]+|(?<![a-z0-9.-])[a-z0-9-][a-z0-9.-]*\.amazonaws\.com\b"""
GATES = [r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", r"A[KS]IA[A-Z0-9]{16}", HEX]
#: Kinds in the order in which equal starts are listed.
KINDS = ["assign", "access", "hex", "linked_access", "linked_secret", "linked_endpoint"]


def _spans(kind: str, found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end")))


def _base(text: Column) -> dict[str, Column]:
    values = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v))
    both = F.arrays_zip(places(text, ASSIGN).alias("place"), values.alias("value"))
    assign = F.transform(F.filter(both, lambda x: x["value"] >= SHORTEST_VALUE), lambda x: x["place"])
    access = F.filter(places(text, ACCESS), lambda s: s["end"] - s["start"] >= SHORTEST_ACCESS)
    return {"assign": assign, "access": access, "hex": places(text, HEX)}


def _near(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """The rows of ``left`` (id, start, end) that have a row of ``right`` within ``scope`` in the same document."""
    buckets = F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope)))
    a = left.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))))
    b = right.select("id", F.col("start").alias("s"), F.col("end").alias("e"), buckets.alias("bucket"))
    apart = F.greatest(F.col("s") - F.col("end"), F.col("start") - F.col("e"))
    return a.join(b, ["id", "bucket"]).where((apart <= scope) & (apart >= 0)).select("id", "start", "end").distinct()


def linked(gated: DataFrame, scope: int = SCOPE) -> DataFrame:
    """id and spans (start, rank, end) of weak parts that have their complement in scope, from (id, text)."""
    parts = gated.select("id", *[places(F.col("text"), p).alias(k) for k, p in {
        "access": r"(?<![A-Z0-9])AKIA[A-Z0-9]{16,}", "temporary": TEMPORARY, "secret": BARE_SECRET, "endpoint": ENDPOINT}.items()])
    of = lambda kind: parts.select("id", F.explode(kind).alias("s")).select("id", "s.start", "s.end")
    identifiers = of("access").unionByName(of("temporary"))
    secrets = _near(of("secret"), identifiers, scope)
    found = {"linked_access": _near(of("temporary"), of("secret"), scope), "linked_secret": secrets,
             "linked_endpoint": _near(_near(of("endpoint"), identifiers, scope), secrets, scope)}
    rows = None
    for kind, part in found.items():
        part = part.select("id", F.struct("start", F.lit(KINDS.index(kind)).alias("rank"), "end").alias("span"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("id").agg(F.collect_set("span").alias("more"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base and spans (kind:start:end lists) of every row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.struct("doc_id", F.xxhash64(text).alias("tk")).alias("id"))
    suspicious = F.lit(False)
    for gate in GATES:
        suspicious = suspicious | F.rlike("text", F.lit(gate))
    gated = rows.where(suspicious).select("id", "text").dropDuplicates(["id"])
    base = gated.select("id", *[_spans(kind, found).alias(kind) for kind, found in _base(F.col("text")).items()])
    marks = base.join(linked(gated, scope), "id", "left")
    all_base = F.concat("assign", "access", "hex")
    marks = marks.select(
        "id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]], _listed(all_base).alias("base"),
        _listed(F.when(F.col("more").isNull(), all_base).otherwise(F.concat(all_base, "more"))).alias("spans"))
    return rows.select("doc_id", "id").join(marks, "id", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.coalesce("base", F.lit("")).alias("base"), F.coalesce("spans", F.lit("")).alias("spans"))
