"""Secret scans with corpus-wide ownership frequency, in DataFrame operations only.

Candidates are the spans of three kinds of patterns and long mixed strings.  Their hashes are counted over the corpus by
distinct documents (repositories) and owners: a value that several owners hold is a copied example, one that a single
owner holds looks live.  Spans are positions in code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.arrays import let, running
from lexforge.llm.staging import staged

#: The kinds, their patterns, the group that holds the value, and its least length.
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
#: The pattern that runs of failing hexadecimal digits need not be visited for: the same matches from 32 digits up.
_LONG_HEX = r"[0-9a-f]{32,}+"
_MIXED = r"[A-Za-z0-9+/_=-]{20,}+"
#: Owners from which on a value counts as widely copied.
COPIED_OWNERS = 3

#: Characters of a block that a masked text is cut from.
_BLOCK = 1024
_FAR = (1 << 31) - 1
_SPAN = "struct<start:int,kind:int,end:int,hash:string>"


def _spans(whole: str, value: str, pieces: str, least: int, kind: int) -> Column:
    """Positions of matches: every match follows the pieces and matches before it; values that are too short are dropped."""
    rows = F.arrays_zip(F.col(whole).alias("w"), F.col(value).alias("v"), F.slice(pieces, 1, F.greatest(F.size(whole), F.lit(0))).alias("p"))
    ends = running(F.transform(rows, lambda z: F.length(z["p"]) + F.length(z["w"])), lambda x, y: x + y)
    placed = F.filter(F.arrays_zip(rows.alias("z"), ends.alias("end")), lambda m: F.length(m["z"]["v"]) >= least)
    found = F.transform(placed, lambda m: F.struct((m["end"] - F.length(m["z"]["w"])).alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"), F.sha2(m["z"]["v"], 256).alias("hash")))
    return F.when(F.size(whole) == 0, F.array().cast(f"array<{_SPAN}>")).otherwise(found)


def _outside(base: str, spans: Column) -> Column:
    """Of ``spans`` (kind len(KINDS)) those that meet no base span: none that begins before ends inside, and none begins inside."""
    both = F.array_sort(F.concat(F.col(base), spans))
    own = len(KINDS)
    before = running(F.transform(both, lambda s: F.when(s["kind"] < own, s["end"]).otherwise(-1)), lambda x, y: F.greatest(x, y))
    after = F.reverse(running(F.reverse(F.transform(both, lambda s: F.when(s["kind"] < own, s["start"]).otherwise(_FAR))), lambda x, y: F.least(x, y)))
    free = F.filter(F.arrays_zip(both.alias("s"), before.alias("before"), after.alias("after")), lambda z: (z["s"]["kind"] == own) & (z["before"] <= z["s"]["start"]) & (z["after"] >= z["s"]["end"]))
    return F.when((F.size(base) == 0) | (F.size(spans) == 0), spans).otherwise(F.transform(free, lambda z: z["s"]))


def _named(spans: Column, names: tuple[str, ...]) -> Column:
    """kind:start:end, comma-joined, by start and then kind."""
    kinds = F.array(*[F.lit(x) for x in names])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


NAMES = tuple(k for k, *_ in KINDS) + ("owned",)


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """Rows (row, doc_id, key, owner, base, mixed), ``key`` a hash of the text: arrays of spans (start, kind, end, hash of the value) of each row, without its text.

    ``base``: the three kinds.  ``mixed``: strings of 20 and more characters that hold letters and digits and lie outside
    of base spans.
    """
    out = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("key"), F.col(owner_col).cast("string").alias("owner"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    patterns = [(_LONG_HEX if name == "hex" else rx, group, least, k) for k, (name, rx, group, least) in enumerate(KINDS)] + [(_MIXED, 0, 20, len(KINDS))]
    for rx, group, least, k in patterns:
        out = out.withColumn(f"w{k}", F.regexp_extract_all("text", F.lit(rx), F.lit(0)))
    for rx, group, least, k in patterns:
        out = out.withColumn(f"v{k}", F.when(F.size(f"w{k}") == 0, F.array().cast("array<string>")).otherwise(F.regexp_extract_all("text", F.lit(rx), F.lit(group))) if group else F.col(f"w{k}"))
        out = out.withColumn(f"p{k}", F.when(F.size(f"w{k}") > 0, F.split("text", rx, -1)))
    out = out.drop("text")
    out = out.select("doc_id", "key", "owner", *[_spans(f"w{k}", f"v{k}", f"p{k}", least, k).alias(f"s{k}") for rx, group, least, k in patterns], F.col(f"w{len(KINDS)}").alias("strings"))
    mixed = F.filter(F.arrays_zip(F.col(f"s{len(KINDS)}").alias("s"), F.col("strings").alias("v")), lambda z: z["v"].rlike("[0-9]") & z["v"].rlike("[A-Za-z]"))
    out = out.select("doc_id", "key", "owner", F.concat(*[F.col(f"s{k}") for k in range(len(KINDS))]).alias("base"), F.transform(mixed, lambda z: z["s"]).alias("mixed"))
    return out.select(F.monotonically_increasing_id().alias("row"), "doc_id", "key", "owner", "base", _outside("base", F.col("mixed")).alias("mixed"))


def ownership(found: DataFrame) -> DataFrame:
    """Rows (hash, n_repos, n_owners) of all candidate values: distinct documents and distinct owners that hold each."""
    held = found.select("doc_id", "owner", F.explode(F.concat("base", "mixed")).alias("s")).select("doc_id", "owner", F.col("s.hash").alias("hash")).distinct()
    by_owner = held.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_repos"), F.count("*").alias("n_owners"))


def classified(found: DataFrame) -> DataFrame:
    """Rows (row, doc_id, key, start, kind, end, hash, n_repos, n_owners, verdict) of all spans; verdict: live, shared or copied."""
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = ownership(found).repartition(n, "hash", "n_repos")  # so that the join can split a value that very many documents hold
    each = found.select("row", "doc_id", "key", F.explode(F.concat("base", "mixed")).alias("s")).select("row", "doc_id", "key", "s.*")
    verdict = F.when(F.col("n_owners") == 1, "live").when(F.col("n_owners") < COPIED_OWNERS, "shared").otherwise("copied")
    return each.join(counts, "hash").withColumn("verdict", verdict)


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """One row (doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied) for each row of ``df``.

    ``spans`` has the base spans and, as ``owned``, mixed strings that a single owner holds.  ``n_live``: spans that look
    live; ``n_copied``: base spans whose value at least COPIED_OWNERS owners hold.  A null or empty text has no spans; a
    null owner is an owner of its own; repeated rows give repeated results and count as one document; an empty table
    gives an empty one.  Columns other than these three are not read.
    """
    found = staged(candidates(df, id_col, text_col, owner_col), "candidates")
    own = len(KINDS)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    base = found.select("row", "doc_id", *[count(k).alias(f"n_{name}") for k, (name, *_) in enumerate(KINDS)], F.sha2(_named(plain(F.col("base")), NAMES), 256).alias("base_sha256"), plain(F.col("base")).alias("base"), F.size(F.concat("base", "mixed")).alias("n"))
    live = classified(found).groupBy("row").agg(
        F.collect_list(F.when((F.col("kind") == own) & (F.col("verdict") == "live"), F.struct("start", "kind", "end"))).alias("owned"),
        F.count_if(F.col("verdict") == "live").alias("n_live"),
        F.count_if((F.col("verdict") == "copied") & (F.col("kind") < own)).alias("n_copied"),
    )
    some = base.filter("n > 0").join(live, "row")
    none = base.filter("n = 0").withColumn("owned", F.col("base")).withColumn("n_live", F.lit(0).cast("long")).withColumn("n_copied", F.lit(0).cast("long"))
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "owned", "n_live", "n_copied"]
    rows = some.select(*columns).unionByName(none.select(*columns))
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", _named(F.concat("base", "owned"), NAMES).alias("spans"), "n_live", "n_copied")


def redact_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", mask: str = "[secret]", owned: bool = False) -> DataFrame:
    """``df`` with ``mask`` in place of base spans, other than those whose value is a widely copied example.

    Owners are counted over all rows and both kinds of spans, as in ``scan_secrets``.  With ``owned``, mixed strings that
    a single owner holds are masked too.  All rows and columns stay; spans that overlap become one mask; null and empty texts stay as they are.
    """
    own = len(KINDS)
    # only texts with a pattern that may be masked travel to the join
    patterns = [_LONG_HEX if name == "hex" else rx for name, rx, _, _ in KINDS] + [_MIXED] * owned
    any_of = F.coalesce(F.col(text_col).cast("string").rlike("|".join(f"(?:{rx})" for rx in patterns)), F.lit(False))
    found = staged(candidates(df, id_col, text_col, owner_col), "candidates")
    gone = (F.col("kind") < own) & (F.col("verdict") != "copied")
    if owned:
        gone |= F.col("verdict") == "live"
    spans = classified(found).filter(gone).groupBy(F.col("doc_id").alias("id"), F.col("key").alias("hash")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    # the caller's columns travel in one, so that none can clash with those of the join
    rows = df.filter(any_of).select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    some = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("hash")), "left")
    masked = F.when(F.col("spans").isNull(), F.col("text")).otherwise(_masked(F.col("text"), F.col("spans"), mask))
    names = [f.name for f in df.schema.fields]
    some = some.select(masked.alias("masked"), "row").select(*[(F.col("masked") if c == text_col else F.col("row").getField(c)).alias(c) for c in names])
    return some.unionByName(df.filter(~any_of).withColumn(text_col, F.col(text_col).cast("string")))


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with ``mask`` in place of sorted spans, of which those that overlap are one.

    What stands between them is cut from the few blocks of the text that hold it, not from its beginning each time.
    """

    def piece(blocks: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / _BLOCK).cast("int")
        some = F.array_join(F.slice(blocks, first + 1, F.floor((b - 1) / _BLOCK).cast("int") - first + 1), "")
        return F.when(a < b, F.substring(some, F.pmod(a, F.lit(_BLOCK)) + 1, b - a)).otherwise("")

    ends = running(F.transform(spans, lambda s: s["end"]), lambda x, y: F.greatest(x, y))
    gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), ends).alias("a"), F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text))).alias("b"))
    out = let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0)), lambda blocks: F.array_join(F.transform(F.filter(gaps, lambda g: g["a"] <= g["b"]), lambda g: piece(blocks, g["a"], g["b"])), mask))
    return out
