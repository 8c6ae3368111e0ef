"""Mixing sources to target weights by pivotal dependent rounding.

Targets: sources in code point order (NULL last) weigh 3, 1, 2, 3, ... and
share 150 % of all words; no source's target exceeds twice its words, and what
is cut there is shared again by weight.  Each document is then wanted
``target / source words`` times, a number from 0 to 2: its whole part is taken
for certain, its fraction is rounded.

Rounding: two documents of a source with fractions p and q and sizes a and b
play against each other.  Words move from one to the other, a*p + b*q staying the
same, until one fraction is 0 or 1; the direction is drawn so that both
expectations stay.  Documents are folded in blocks of about a hundred, each block leaves
one unfinished document, and those meet in blocks again: a reduction tree whose
top rounds one document per source.  So a source's taken words differ from its
target by less than one document.

Defined results: a NULL text has size 0; a document of size 0 takes 0 words; NULL
and empty sources are different sources; repeated rows are rounded apart;
an empty table gives an empty result.  Draws depend on the values only (ids,
sizes and repetition), so reruns agree whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splitlens.llm.common import WORDS, attach, uniform, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BLOCK = 100             # documents folded together, on average
SEED = 8
RUN = 4096              # equal rows unrolled or numbered together

_ITEM = "struct<h: bigint, id: bigint, size: bigint, rep: bigint, p: double>"
_DONE = "struct<id: bigint, size: bigint, rep: bigint, up: int>"
_OWN = ["source", "words", "target", "base"]      # the same for all rows of a source


def _before(rows: DataFrame, order: list, sums: dict, label: str) -> DataFrame:
    """``rows`` with, for each name of ``sums``, the sum of its expression over all rows before
    in ``order``: by ranges, each summed by itself, and the sums of the ranges before."""
    ranged = written(rows.repartitionByRange(*order).withColumn("_llm_range", F.spark_partition_id()), label)
    earlier = Window.partitionBy("_llm_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("_llm_range").agg(*[F.sum(x).alias(f"_llm_{n}") for n, x in sums.items()])
    # One row per range, so as many as there are shuffle partitions.
    ranks = Window.orderBy("_llm_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_llm_range", *[F.coalesce(F.sum(f"_llm_{n}").over(ranks), F.lit(0)).alias(f"_llm_{n}") for n in sums])
    joined = ranged.join(F.broadcast(ranges), "_llm_range")
    return joined.withColumns({n: F.coalesce(F.sum(x).over(earlier), F.lit(0)) + F.col(f"_llm_{n}") for n, x in sums.items()}).drop(
        "_llm_range", *[f"_llm_{n}" for n in sums])


def targets(sizes: DataFrame) -> DataFrame:
    """(skey, words, rows, target) per source of ``sizes`` (source, size, n).

    With r = MOST * words / weight, the sources of the smallest r are cut, and
    the others share what is left: prefix sums over r find how many are cut.  Sources
    may be very many (hosts): ranks and sums run over ranges of them, and sums are of whole numbers, so
    they do not depend on the ranges.
    """
    per = (sizes.groupBy("source")
           .agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("rows")))
    ranked = _before(per, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)}, "mix-ranks")
    w = F.element_at(F.array(*[F.lit(x) for x in WEIGHTS]), (F.pmod(F.col("rank"), F.lit(len(WEIGHTS))) + 1).cast("int"))
    ranked = ranked.withColumns({"w": w.cast("long"), "cap": F.col("words") * F.lit(MOST)})
    ranked = _before(ranked.withColumn("r", F.col("cap") / F.col("w")), [F.col("r"), F.col("rank")],
                     {"caps": F.col("cap"), "weights": F.col("w")}, "mix-levels")
    whole = ranked.agg(F.sum("words").alias("all_words"), F.sum("w").alias("all_weights"))      # one row
    level = (F.col("all_words") * F.lit(SHARE) - F.col("caps")) / (F.col("all_weights") - F.col("weights"))
    levelled = ranked.crossJoin(F.broadcast(whole)).withColumn("level", level)
    # The level at the first source that is not cut holds for all later ones.
    free = levelled.agg(F.min(F.when(F.col("level") * F.col("w") < F.col("cap"), F.struct("r", "rank", "level"))).alias("free"))     # one row
    share = F.coalesce(F.col("free.level") * F.col("w"), F.col("cap"))
    return levelled.crossJoin(F.broadcast(free)).select(_skey().alias("skey"), "words", "rows", F.least(F.col("cap"), share).alias("target"))


def _skey():
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))


def repeated(rows: DataFrame, n: str, name: str) -> DataFrame:
    """Each of ``rows`` ``n`` times, numbered from 1 in ``name``.  Large numbers are cut into
    runs that are dealt out before they are unrolled, so no task or array holds them."""
    few = rows.where(F.col(n) <= RUN).withColumn(name, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))))
    many = rows.where(F.col(n) > RUN).withColumn("_llm_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / RUN))))
    many = many.repartition("_llm_run").withColumn(name, F.explode(F.sequence(
        F.col("_llm_run") * RUN + 1, F.least(F.col(n), (F.col("_llm_run") + 1) * RUN))))
    return few.unionByName(many.drop("_llm_run"))


def _fold() -> str:
    """SQL of one step: the document left over so far meets the next one."""
    up, down = "least((1 - s.res.p) * s.res.size, e.p * e.size)", "least(s.res.p * s.res.size, (1 - e.p) * e.size)"
    draw = f"(shiftrightunsigned(xxhash64(s.res.h, e.h, {SEED}L), 11) + 0.5D) / {float(1 << 53)}D"

    def settle(done: str, value: int, left: str, p: str) -> str:
        return (f"named_struct('res', named_struct('h', {left}.h, 'id', {left}.id, 'size', {left}.size, "
                f"'rep', {left}.rep, 'p', least(1D, greatest(0D, {p}))), 'done', concat(s.done, array(named_struct("
                f"'id', {done}.id, 'size', {done}.size, 'rep', {done}.rep, 'up', {value}))))")

    r = "s.res"
    return f"""CASE
      WHEN s.res IS NULL THEN named_struct('res', e, 'done', s.done)
      WHEN {up} + {down} = 0 OR {draw} < {down} / ({up} + {down}) THEN
        CASE WHEN (1 - s.res.p) * s.res.size <= e.p * e.size
          THEN {settle(r, 1, 'e', 'e.p - (1 - s.res.p) * s.res.size / e.size')}
          ELSE {settle('e', 0, r, 's.res.p + e.p * e.size / s.res.size')} END
      ELSE
        CASE WHEN s.res.p * s.res.size <= (1 - e.p) * e.size
          THEN {settle(r, 0, 'e', 'e.p + s.res.p * s.res.size / e.size')}
          ELSE {settle('e', 1, r, 's.res.p - (1 - e.p) * e.size / s.res.size')} END
    END"""


def _round_level(items: DataFrame, level: int) -> DataFrame:
    """One level of the tree: (skey, res, done) per block of ``items``.  A block
    holds about BLOCK items, since items are dealt by a hash of their own."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("rows") / F.lit(float(BLOCK ** level))))
    dealt = items.withColumn("b", F.pmod(F.xxhash64(F.col("item.h"), F.lit(level)), blocks))
    held = dealt.groupBy("skey", "b").agg(
        F.first("own").alias("own"), F.first("rows").alias("rows"),
        F.sort_array(F.collect_list("item")).alias("items"))
    start = f"named_struct('res', cast(null AS {_ITEM}), 'done', cast(array() AS array<{_DONE}>))"
    state = f"struct<res: {_ITEM}, done: array<{_DONE}>>"
    return held.withColumn("s", F.expr(
        f"aggregate(items, cast({start} AS {state}), (s, e) -> cast({_fold()} AS {state}))")).select(
        "skey", "rows", "own", F.col("s.res").alias("res"), F.col("s.done").alias("done"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: the id, ``size``, ``source_size``,
    ``target``, ``taken`` and ``copies`` (``taken`` is copies times size), with the
    source and ``rep``, the number of the row among rows equal in id,
    size and source."""
    out = mix_sizes(docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                                F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORDS)).cast("long").alias("size"))
                    .groupBy("source", "id", "size").agg(F.count("*").alias("n")))
    return out.withColumnsRenamed({"id": id_col, "source": source_col})


def mix_sizes(sizes: DataFrame) -> DataFrame:
    """``mix`` of ``n`` documents for each (id, source, size) of ``sizes``."""
    sizes = written(sizes, "mix-sizes")
    wanted = written(targets(sizes), "mix-targets")
    stats = wanted.agg(F.sum("rows"), F.max("rows")).first()
    total, most = int(stats[0] or 0), int(stats[1] or 0)
    rows = attach(sizes.withColumn("skey", _skey()), wanted, "skey", "rows", ["id", "size"], total,
                  ["words", "rows", "target"])
    ratio = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(F.lit(0.0))
    rows = (rows.withColumn("base", F.floor(ratio + 1e-12).cast("int"))
            .withColumn("p", F.greatest(F.lit(0.0), ratio - F.col("base")))
            .withColumn("p", F.when((F.col("p") < 1e-12) | (F.col("size") == 0), 0.0).otherwise(F.col("p"))))
    rows = (repeated(rows, "n", "rep")
            .withColumn("h", F.xxhash64("id", "size", "rep", F.lit(SEED))))

    def rounded(df: DataFrame) -> DataFrame:
        copies = F.col("own.base") + F.col("up")
        return df.select("id", "size", F.col("own.words").alias("source_size"),
                         F.col("own.target").alias("target"), (copies * F.col("size")).alias("taken"),
                         copies.alias("copies"), F.col("own.source").alias("source"), "rep")

    own, item = F.struct(*_OWN).alias("own"), F.struct("h", "id", "size", "rep", "p").cast(_ITEM).alias("item")
    out = rounded(rows.where("p = 0").select("id", "size", "rep", own, F.lit(0).alias("up")))
    items, level, last = rows.where("p > 0").select("skey", "rows", own, item), 0, False
    while not last:
        level += 1
        last = most <= BLOCK ** level
        step = written(_round_level(items, level), f"mix-level{level}")
        out = out.unionByName(rounded(step.select("own", F.explode("done").alias("d")).select("own", "d.*")))
        left = step.where("res IS NOT NULL")
        if last:
            lucky = uniform(F.col("res.h"), F.lit(SEED)) < F.col("res.p")
            out = out.unionByName(rounded(left.select("own", "res.id", "res.size", "res.rep", lucky.cast("int").alias("up"))))
        else:
            items = left.select("skey", "rows", "own", F.col("res").alias("item"))
    return out


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (row, ``keys``; a written table) with ``rep``, 1 to n among rows equal in ``keys``.  Large
    groups are numbered in slices of about ``RUN`` rows, which then add up."""
    sizes = written(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
                    .withColumn("key", F.xxhash64(*keys)), "mix-repeats")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # The hash of a key only says which rows may repeat, and how often about: slices need no more.
    hashed = sizes.groupBy("key").agg(F.max("n").alias("n"))
    sliced = attach(rows.withColumn("key", F.xxhash64(*keys)), hashed, "key", "n", ["row"], total, ["n"])
    slices = F.greatest(F.lit(1), F.ceil(F.coalesce("n", F.lit(1)) / RUN))
    sliced = written(sliced.withColumn("slice", F.pmod(F.xxhash64("row"), slices)).drop("n", "key"), "mix-slices")
    here = sliced.groupBy(*keys, "slice").agg(F.count("*").alias("k"))
    before = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    here = here.withColumn("first", F.coalesce(F.sum("k").over(before), F.lit(0))).where("first > 0").select(
        *[F.col(c).alias(f"_b_{c}") for c in [*keys, "slice"]], "first")
    local = sliced.withColumn("rep", F.row_number().over(Window.partitionBy(*keys, "slice").orderBy("row")))
    same = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in [*keys, "slice"]]
    out = local.join(here, same, "left").withColumn("rep", (F.col("rep") + F.coalesce("first", F.lit(0))).cast("long"))
    return out.select("row", *keys, "rep")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """``docs`` with every row as often as the mix takes it (not at all, once
    or twice).  The rows are numbered and written once; which of them are taken is settled on their
    numbers, ids, sources and sizes, and the texts are shuffled once, to meet the result."""
    rows = written(docs.withColumn("_llm_row", F.monotonically_increasing_id()), "mix-documents")
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORDS)).cast("long")
    narrow = written(rows.select(F.col("_llm_row").alias("row"), F.col(id_col).cast("long").alias("id"),
                                 F.col(source_col).cast("string").alias("source"), size.alias("size")), "mix-narrow")
    keys = ["id", "source", "size"]
    taken = mix_sizes(narrow.groupBy(*keys).agg(F.count("*").alias("n"))).where("copies > 0").select(
        *[F.col(c).alias(f"_m_{c}") for c in [*keys, "rep"]], "copies")
    same = [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in [*keys, "rep"]]
    copies = numbered(narrow, keys).join(taken, same).select(F.col("row").alias("_llm_row"), F.col("copies").alias("_llm_copies"))
    return (rows.join(copies, "_llm_row").withColumn("_llm_copy", F.explode(F.sequence(F.lit(1), F.col("_llm_copies"))))
            .select(*docs.columns))
