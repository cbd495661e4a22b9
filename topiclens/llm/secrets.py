"""Secrets in texts: certain ones by their form, weak ones by what stands near them.

A short secret, a short access identifier, a user name or an endpoint alone says little.
Such a candidate is reported only if complementary parts lie within SCOPE code points:
an identifier needs a secret, a secret needs an identifier or an endpoint, an endpoint
needs an identifier and a secret. Certain secrets count as parts too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiclens.llm.common import free_name

SCOPE = 200


@dataclass(frozen=True)
class Kind:
    """A form of secret: certain from `sure` characters of its group on, weak from `weak` on."""

    name: str
    part: str
    pattern: str
    group: int
    sure: int | None
    weak: int | None


KINDS = (
    Kind(
        "assign", "secret",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12, 4,
    ),
    Kind("access", "identifier", r"AKIA[A-Z0-9]+", 0, 18, 12),
    Kind("hex", "secret", r"[0-9a-f]+", 0, 16, None),
    Kind(
        "user", "identifier",
        r"""(?i)(user_?name|user_?id|user|login|account|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]+)""",
        2, None, 3,
    ),
    Kind(
        "endpoint", "endpoint",
        r"""(?i)(https?|ftp|ssh|amqp|redis|mysql|postgres|mongodb|s3)://[^\x00-\x20"'<>]+""",
        0, None, 10,
    ),
)
BASE = [k.name for k in KINDS if k.sure]
PARTS = ("identifier", "secret", "endpoint")


def _pieces(text: Column, kind: Kind) -> Column:
    """The matches of a kind: for each, the length before it, its own, and its group's."""
    # Hex runs that are too short are never wanted, and a run that is long enough is one match.
    pattern = f"[0-9a-f]{{{kind.sure},}}" if kind.name == "hex" else kind.pattern
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("before"),
        matches.alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(kind.group)).alias("value"),
    )
    found = F.transform(
        F.slice(zipped, 1, F.size(matches)),
        lambda x: F.struct(
            F.char_length(x["before"]).cast("long").alias("before"),
            F.char_length(x["match"]).cast("long").alias("size"),
            F.char_length(x["value"]).alias("value"),
        ),
    )
    return F.struct(F.lit(kind.name).alias("kind"), F.when(F.size(matches) > 0, found).alias("found"))


def candidates(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, sum, kind, start, end, sure): all candidates, in code points, end exclusive.

    sum is a hash of the text, so that rows that repeat an id are told apart.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = (
        docs.select(
            F.col(f"`{id}`").alias("id"),
            F.xxhash64(F.col(f"`{text}`")).alias("sum"),
            F.monotonically_increasing_id().alias("row"),
            F.inline(F.array(*[_pieces(body, k) for k in KINDS])),
        )
        .where("found IS NOT NULL")
        .select("id", "sum", "row", "kind", F.posexplode("found").alias("i", "m"))
        .select("id", "sum", "row", "kind", "i", "m.*")
    )
    # One text's matches of one kind, in their order.
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("before") + F.col("size")).over(so_far)
    placed = found.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    sure = F.coalesce(*[F.when(F.col("kind") == k.name, F.col("value") >= k.sure) for k in KINDS if k.sure], F.lit(False))
    weak = F.coalesce(*[F.when(F.col("kind") == k.name, F.col("value") >= k.weak) for k in KINDS if k.weak], F.lit(False))
    return (
        placed.withColumn("sure", sure)
        .where(F.col("sure") | weak)
        .select("id", "sum", "kind", "start", "end", "sure")
        .distinct()
    )


def _near(spans: DataFrame, scope: int) -> DataFrame:
    """Add to weak candidates whether a part of each sort lies within `scope` code points.

    The text is cut into bins of `scope`. Each bin has, for each part, the first start and
    the last end of the spans in it; as a bin is shorter than the interval that is looked
    up, those two tell exactly whether any span of the bin meets it. So a candidate meets a
    few bins, not all other candidates.
    """
    part = F.coalesce(*[F.when(F.col("kind") == k.name, F.lit(k.part)) for k in KINDS])
    spans = spans.withColumn("part", part)
    bins = (
        spans.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope))))
        .groupBy("id", "sum", "bin")
        .agg(
            *[F.min(F.when(F.col("part") == p, F.col("start"))).alias(f"first_{p}") for p in PARTS],
            *[F.max(F.when(F.col("part") == p, F.col("end"))).alias(f"last_{p}") for p in PARTS],
        )
    )
    bins = bins.withColumnsRenamed({"id": "bin_id", "sum": "bin_sum"})
    reach = F.sequence(
        F.floor(F.greatest(F.col("start") - scope, F.lit(0)) / scope),
        F.floor((F.col("end") + scope) / scope),
    )
    looked = spans.where("NOT sure").withColumn("look", F.explode(reach)).join(
        bins,
        F.col("id").eqNullSafe(F.col("bin_id")) & (F.col("sum") == F.col("bin_sum")) & (F.col("look") == F.col("bin")),
    )
    meets = lambda p: (F.col(f"first_{p}") <= F.col("end") + scope) & (F.col(f"last_{p}") >= F.col("start") - scope)
    return looked.groupBy("id", "sum", "kind", "start", "end", "part").agg(
        *[F.max(F.coalesce(meets(p), F.lit(False))).alias(f"near_{p}") for p in PARTS]
    )


def credential_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, sum, kind, start, end, sure): certain secrets, and weak ones with their complement."""
    found = candidates(docs, id, text)
    near = _near(found, scope)
    linked = (
        ((F.col("part") == "identifier") & F.col("near_secret"))
        | ((F.col("part") == "secret") & (F.col("near_identifier") | F.col("near_endpoint")))
        | ((F.col("part") == "endpoint") & F.col("near_identifier") & F.col("near_secret"))
    )
    weak = near.where(linked).select("id", "sum", "kind", "start", "end", F.lit(False).alias("sure"))
    return found.where("sure").unionByName(weak)


def credentials(docs: DataFrame, id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, weak, hits), a row for each row of docs.

    base_sha256 and spans list kind:start:end by start, then kind, joined by commas; the
    base spans are the certain ones, weak counts the others, hits is the list as an array of
    (kind, start, end). Null and empty texts have none; other columns are not looked at;
    rows that repeat an id are judged each by its own text; an empty table gives no rows.
    """
    order = F.coalesce(*[F.when(F.col("kind") == k.name, F.lit(i)) for i, k in enumerate(KINDS)])
    spans = credential_spans(docs, id, text, scope)
    each = (
        spans.withColumn("order", order)
        .groupBy("id", "sum")
        .agg(F.array_sort(F.collect_set(F.struct("start", "order", "kind", "end", "sure"))).alias("all"))
        .withColumnsRenamed({"id": "hit_id", "sum": "hit_sum"})
    )
    keyed = docs.select(F.col(f"`{id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("sum"))
    out = keyed.join(
        each, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("sum") == F.col("hit_sum")), "left"
    )
    none = F.array().cast("array<struct<start:bigint,order:int,kind:string,end:bigint,sure:boolean>>")
    out = out.withColumn("all", F.coalesce("all", none))
    base = F.filter("all", lambda x: x["sure"])
    listed = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    count = lambda name: F.size(F.filter(base, lambda x: x["kind"] == name)).cast("long")
    return out.select(
        F.col("id").alias(id),
        *[count(name).alias(f"n_{name}") for name in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("all")).alias("spans"),
        F.size(F.filter("all", lambda x: ~x["sure"])).cast("long").alias("n_weak"),
        F.transform("all", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("hits"),
    )


def redacted(docs: DataFrame, id: str = "doc_id", text: str = "text", mask: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """docs with every reported span of the text replaced by `mask`; all columns stay.

    Overlapping spans are replaced as one. Rows without a span are left as they are.
    """
    hits = free_name(docs, "hits")
    each = (
        credential_spans(docs, id, text, scope)
        .groupBy(F.col("id").alias("_id"), F.col("sum").alias("_sum"))
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias(hits))
    )
    joined = docs.join(
        each, docs[id].eqNullSafe(each["_id"]) & (F.xxhash64(docs[text]) == each["_sum"]), "left"
    ).select(*[docs[c] for c in docs.columns], hits)
    body = F.col(f"`{text}`")
    # Kept pieces: from the furthest end so far to the next start.
    cleaned = F.aggregate(
        hits,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("kept")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when((x["start"] < s["at"]) & (s["at"] > 0), s["kept"])
            .otherwise(F.concat(s["kept"], F.array(F.substring(body, (s["at"] + 1).cast("int"), F.greatest(x["start"] - s["at"], F.lit(0)).cast("int")))))
            .alias("kept"),
        ),
        lambda s: F.concat(
            F.concat_ws(mask, s["kept"]), F.lit(mask), F.substring(body, (s["at"] + 1).cast("int"), F.char_length(body))
        ),
    )
    return joined.withColumn(text, F.coalesce(cleaned, body)).drop(hits)
