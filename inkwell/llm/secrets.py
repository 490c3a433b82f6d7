"""Secret scanning with multipart credential linking.

Base findings stand on their own: ``assign`` (a credential name given a value
of eight or more characters), ``access`` (``AKIA...``, 16 or more) and ``hex``
(32 or more hex digits).

Parts are weaker: access identifiers, secret-like strings and endpoints.  None
is evidence alone.  They become rows (scope, kind, start, end) and are linked by
an interval join within their scope, a text: a secret-like string is reported
when an access identifier starts or ends within ``REACH`` characters of it, and
an endpoint when both an identifier and a secret-like string do.  The join asks
only whether a complementary part exists in reach, so it is answered by running
maxima over the ordered parts of a scope (the nearest part before and after),
and no scope is expanded into pairs.

Kinds of linked spans: ``secret``, ``endpoint``, ``access_id`` (an identifier
too weak for ``access``, next to a secret-like string).

Edge cases: NULL and empty texts have no span and the digest of the empty
string; repeated rows give equal results; equal texts are one scope; long texts
are scanned whole; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm._scratch import materialize, ship

REACH = 400
# The base patterns and their least lengths.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_MIN, ACCESS_MIN = 8, 16
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "access_id", "secret", "endpoint")

# Parts that mean nothing alone.
PART_ID = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA|AROA|AIDA|AIza|LTAI|AC|SK|ghp_|xox[abp]-)[A-Za-z0-9_-]{8,}")
# A value may follow "NAME=" directly; "=" inside it is padding, so a name before "=" is no value.
PART_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
PART_ENDPOINT = re.compile(r"(?:https?|jdbc:\w+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]+")

_BASE = ("doc_id long, scope binary, n_assign long, n_access long, n_hex long, base_sha256 string, base string, "
         "parts array<struct<kind:string,start:int,end:int>>")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind number, kind, end) of the base findings, ordered."""
    found = []
    lowered = text.lower()
    if any(n in lowered for n in NAMES):
        found += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _mixed(s: str) -> bool:
    """Digits and letters of both cases: not a word, not a number."""
    return any(c.isdigit() for c in s) and any(c.islower() for c in s) and any(c.isupper() for c in s)


def parts(text: str) -> list[dict]:
    """Weak parts, if there is an identifier among them (nothing can link without one)."""
    ids = [m for m in PART_ID.finditer(text) if any(c.isdigit() for c in m.group())]
    if not ids:
        return []
    out = [{"kind": "access_id", "start": m.start(), "end": m.end()} for m in ids]
    taken = {m.start() for m in ids}
    out += [{"kind": "secret", "start": m.start(), "end": m.end()} for m in PART_SECRET.finditer(text)
            if m.start() not in taken and _mixed(m.group())]
    out += [{"kind": "endpoint", "start": m.start(), "end": m.end()} for m in PART_ENDPOINT.finditer(text)]
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            text = text or ""
            spans = base_spans(text)
            base = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)
            count = [sum(1 for s in spans if s[1] == k) for k in range(3)]
            rows.append((*count, hashlib.sha256(base.encode()).hexdigest(), base, parts(text) or None))
        n_assign, n_access, n_hex, digest, base, found = zip(*rows, strict=True) if rows else ((),) * 6
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("scope"), pa.array(n_assign, pa.int64()), pa.array(n_access, pa.int64()),
             pa.array(n_hex, pa.int64()), pa.array(digest, pa.string()), pa.array(base, pa.string()),
             pa.array(found, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))],
            names=["doc_id", "scope", "n_assign", "n_access", "n_hex", "base_sha256", "base", "parts"])


def link_parts(parts_df: DataFrame, reach: int = REACH) -> DataFrame:
    """``scope, kind, start, end`` of the parts whose complements are in reach.

    An interval join ``|gap| <= reach`` within a scope that asks for existence:
    the nearest part of each kind on either side decides.
    """
    before = Window.partitionBy("scope").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("scope").orderBy("start", "end", "kind").rowsBetween(1, Window.unboundedFollowing)

    def near(kind: str):
        left = F.max(F.when(F.col("kind") == kind, F.col("end"))).over(before)
        right = F.min(F.when(F.col("kind") == kind, F.col("start"))).over(after)
        return (F.coalesce(F.col("start") - left <= reach, F.lit(False))
                | F.coalesce(right - F.col("end") <= reach, F.lit(False)))

    near_id, near_secret = near("access_id"), near("secret")
    return (parts_df.withColumn("near_id", near_id).withColumn("near_secret", near_secret)
            .filter((F.col("kind") == "secret") & F.col("near_id") | (F.col("kind") == "access_id") & F.col("near_secret")
                    | (F.col("kind") == "endpoint") & F.col("near_id") & F.col("near_secret"))
            .select("scope", "kind", "start", "end"))


def scan_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked, for every row."""
    ship(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("scope"))
    scanned = materialize(rows.mapInArrow(_scan, _BASE), "scanned")
    weak = scanned.filter("parts is not null").select("scope", F.explode("parts").alias("p")).select("scope", "p.*").distinct()
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    linked = (link_parts(weak, reach).groupBy("scope")
              .agg(F.collect_list(F.struct("start", rank[F.col("kind")].alias("rank"), "kind", "end")).alias("linked")))
    # base spans come back as structs, so that both kinds are ordered together
    base = F.transform(F.filter(F.split("base", ","), lambda s: s != ""), lambda s: F.struct(
        F.split(s, ":")[1].cast("int").alias("start"), rank[F.split(s, ":")[0]].alias("rank"),
        F.split(s, ":")[0].alias("kind"), F.split(s, ":")[2].cast("int").alias("end")))
    plain = scanned.filter("parts is null").select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
                                                  F.col("base").alias("spans"), F.lit(0).alias("n_linked"))
    spans = F.array_join(F.transform(F.array_sort(F.concat(base, F.coalesce("linked", F.array().cast(
        "array<struct<start:int,rank:int,kind:string,end:int>>")))),
        lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    joined = (scanned.filter("parts is not null").join(linked, "scope", "left")
              .select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans.alias("spans"),
                      F.coalesce(F.array_size("linked"), F.lit(0)).alias("n_linked")))
    return plain.unionByName(joined)
