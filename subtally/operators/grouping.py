"""Row selection and neighbours inside groups, safe when one group is very large."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pieces of an order for each shuffle partition, and sampled rows for each piece.
PIECES_PER_PARTITION = 4
SAMPLES_PER_PIECE = 4


#: Rows of the table that drives a deal for each of its tasks.
ROWS_PER_TASK = 25_000


def dealt(frame: DataFrame, key: str, driving: DataFrame) -> DataFrame:
    """Shuffle `frame` by `key` into tasks whose number follows the rows of `driving`.

    For stages that hold much more than they read: adaptive execution sizes tasks by the
    compressed rows that come in, and would put together so many that a task grows with the
    data up to gigabytes. The count of a stored table reads no column. Few rows are left to
    adaptive execution.
    """
    tasks = -(-driving.count() // ROWS_PER_TASK)
    return frame.repartition(tasks, key) if tasks > 1 else frame.repartition(key)


#: Words of 64 bits in a filter of keys (1 MB).
FILTER_WORDS = 1 << 17


def may_be_in(frame: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """All rows whose `key` is in the one column of `values`, and few others; an exact join has to follow.

    The hashes of the values are bits of a filter of fixed size, a scalar subquery. Rows are
    dropped before they are shuffled for the join. A filter that many values fill lets more rows
    through, which the join drops: the result never depends on it.
    """
    (name,) = values.columns

    def place(column: str) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(column), F.lit(64 * FILTER_WORDS))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))
        return F.shiftright(at, 6).cast("int"), bit

    word, bit = place(name)
    used = values.filter(F.col(name).isNotNull()).groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = frame.sparkSession.range(FILTER_WORDS).select(F.col("id").cast("int").alias("word"))
    dense = F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    words = every.join(used, "word", "left").agg(F.sort_array(F.collect_list(dense)).getField("bits").alias("words"))
    word, bit = place(key)
    return frame.filter(F.get(words.scalar(), word).bitwiseAND(bit) != 0)


def first_per_group(
    frame: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], rank: str = "rn"
) -> DataFrame:
    """The first row of every group, with its rank column (always 1).

    Spark keeps one row per group in every map task before the shuffle
    (WindowGroupLimit), so a hot group costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return frame.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1)


def not_in(frame: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """Rows whose `key` is SQL `NOT IN` the one column of `values`, NULLs included.

    Nothing is left when `values` holds a NULL, everything when it is empty, and a NULL
    key is otherwise dropped. Spark would answer `NOT IN` by broadcasting `values`
    whatever its size. Here one aggregate yields both facts about `values` as a relation of
    one row, which every row of `frame` is held against, and the matching is an ordinary
    anti join.
    """
    (name,) = values.columns
    listed = values.select(F.col(name).alias("__listed"))
    size, known = F.count(F.lit(1)), F.count("__listed")
    # 2: empty, so that every key is kept; 1: without NULL, known keys only; 0: none.
    fact = listed.agg(F.when(size == 0, 2).when(size == known, 1).otherwise(0).alias("fact")).scalar()
    comparable = fact >= F.when(F.col(key).isNull(), 2).otherwise(1)
    return frame.filter(comparable).join(listed, F.col(key) == F.col("__listed"), "left_anti")


def ordered_place(names: Sequence[str]) -> Column:
    """A struct that compares like the named columns in ascending order, NULL last."""
    fields = []
    for i, name in enumerate(names):
        fields += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return F.struct(*fields)


def with_pieces(frame: DataFrame, names: Sequence[str], piece: str = "__piece") -> DataFrame:
    """Cut the order of all rows by `names` into numbered pieces of about equal size.

    The numbers grow along the order, so a key that leads it may lie in many pieces, and
    no piece holds more than a small share of all rows, whoever they belong to. Rows equal
    in all of `names` stay together. The cuts come from a sample of fixed size per shuffle
    partition, the rows of smallest hash, taken as a scalar subquery of the same query;
    each row finds its piece by binary search. The cuts only balance the work: whatever
    they are, numbers follow the order.
    """
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = PIECES_PER_PARTITION * partitions
    place = ordered_place(names)
    sample = (
        frame.select(place.alias("place"))
        .orderBy(F.xxhash64("place"))
        .limit(wanted * SAMPLES_PER_PIECE)
        .agg(F.sort_array(F.collect_list("place")).alias("sorted"))
    )
    every = F.filter("sorted", lambda _, i: i % SAMPLES_PER_PIECE == SAMPLES_PER_PIECE - 1)
    # A column of generated code, read by reference and dropped before any row is copied.
    found = frame.withColumns(
        {"__cuts": sample.select(every).scalar(), "__place": place, "__at": F.lit(0)}
    )
    for k in range(wanted.bit_length() - 1, -1, -1):
        further = F.col("__at") + (1 << k)
        # A place beyond the last cut is NULL, which is no reason to go on.
        passed = F.get("__cuts", further - 1) <= F.col("__place")
        found = found.withColumn("__at", F.when(passed, further).otherwise(F.col("__at")))
    # The optimizer follows a join key down through projections and puts each step into the
    # next one, which doubles it and more; it does not look into what a generator makes.
    return found.select(*[F.col(f"`{name}`") for name in frame.columns], F.explode(F.array("__at")).alias(piece))


def with_neighbours(
    frame: DataFrame,
    key: str,
    order: Sequence[str],
    lags: Mapping[str, str],
    leads: Mapping[str, str],
) -> DataFrame:
    """Previous (`lags`) and next (`leads`) values per `key` in `order`, as name -> source.

    For keys of unbounded size: `order` is ascending, NULL last, and should tell all rows
    of a key apart. All rows are cut into pieces along (key, order) and shuffled once, by
    piece. Each piece finds its neighbours by itself; then its first and last row alone, two
    rows a piece whatever the size of the data, are laid side by side and stitched.
    """
    names = [key, *order]
    inside = Window.partitionBy("__piece").orderBy(*[F.asc_nulls_last(name) for name in names])
    held, after = F.lag(F.struct(key)).over(inside), F.lead(F.struct(key)).over(inside)
    same_before = held.getField(key).eqNullSafe(F.col(key))
    same_after = after.getField(key).eqNullSafe(F.col(key))
    cut = with_pieces(frame, names).withColumns(
        {
            "__first": held.isNull(),
            "__last": after.isNull(),
            **{name: F.when(same_before, F.lag(source).over(inside)) for name, source in lags.items()},
            **{name: F.when(same_after, F.lead(source).over(inside)) for name, source in leads.items()},
        }
    )

    def edge(where: str, sources: Mapping[str, str]) -> Column:
        values = [F.col(source).alias(name) for name, source in sources.items()]
        return F.max(F.when(F.col(where), F.struct(F.col(key).alias("__key"), *values)))

    edges = cut.filter("__first OR __last").groupBy("__piece").agg(
        edge("__first", leads).alias("head"), edge("__last", lags).alias("tail")
    )
    along = Window.orderBy("__piece")
    seams = edges.select(
        "__piece", F.lag("tail").over(along).alias("__tail"), F.lead("head").over(along).alias("__head")
    )
    joined = cut.join(seams, "__piece", "left")

    def stitched(name: str, where: str, seam: str) -> Column:
        of_key = F.col(seam).isNotNull() & F.col(f"{seam}.__key").eqNullSafe(F.col(key))
        outer = F.when(of_key, F.col(f"{seam}.{name}"))
        return F.when(F.col(where), outer).otherwise(F.col(name)).alias(name)

    return joined.select(
        *frame.columns,
        *[stitched(name, "__first", "__tail") for name in lags],
        *[stitched(name, "__last", "__head") for name in leads],
    )
