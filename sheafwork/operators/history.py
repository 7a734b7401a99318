"""Full history of changing entity attributes.

Storage is a checkpoint-delta log: for every entity an entry per snapshot that
taught something new, most holding just the changed attributes (a patch) and
every ``every``-th holding all known attributes (a checkpoint).  States come from
folding patches forward from the nearest checkpoint, so reading the state at a
date touches at most ``every`` entries of an entity; validity rows come from
comparing the folded states of neighbouring entries.

:class:`HistoryStore` keeps such a log in a folder and appends snapshots to it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.operators.incremental import CommitLog
from sheafwork.session import materialise

TRACKED = ("company", "sic", "state_location")


def entity_key(column: Column) -> Column:
    """Surrounding blanks and leading zeros are no part of a key; all zeros is the key 0."""
    return F.regexp_replace(F.trim(column), "^0+(?=.)", "")


def tidy(column: Column) -> Column:
    """Surrounding and repeated blanks removed; nothing left is null."""
    return F.nullif(F.trim(F.regexp_replace(column.cast("string"), r"[\s\u00a0\u2000-\u200a\u202f\u205f\u3000]+", " ")), F.lit(""))


def comparable(name: str, column: Column) -> Column:
    """The form in which two values of an attribute count as equal."""
    folded = F.lower(tidy(column))
    return F.regexp_replace(folded, "^0+(?=.)", "") if name == "sic" else folded


def deliveries(snapshots: DataFrame, key: str = "cik", as_of: str = "snapshot_date", loaded: str = "loaded_at", tracked: Sequence[str] = TRACKED) -> DataFrame:
    """(entity, as_of, row) of the row loaded last per entity and date; ``row`` holds the load time and v0, v1, ...

    Ties go to the greatest attribute values; a null load time is the earliest.
    Rows without key or ``as_of`` belong to no history and are left out.  A hot
    entity collapses to one row per snapshot date by a partial aggregate.
    """
    rows = snapshots.select(
        entity_key(F.col(key)).alias("entity"),
        F.col(as_of).alias("as_of"),
        F.struct(F.col(loaded).alias("loaded"), *[tidy(F.col(c)).alias(f"v{i}") for i, c in enumerate(tracked)]).alias("row"),
    ).filter(F.col("entity").isNotNull() & (F.col("entity") != "") & F.col("as_of").isNotNull())
    return _latest(rows)


def _latest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("entity", "as_of").agg(F.max("row").alias("row"))


def log_entries(rows: DataFrame, tracked: Sequence[str] = TRACKED, every: int = 8, base: DataFrame | None = None) -> DataFrame:
    """Log entries of deliveries, continuing the entities in ``base`` (entity, seq and their known state).

    Null says nothing, so the last known value holds.  Dates, not rows, bound a
    window's partition.  Columns: entity, seq, as_of, is_checkpoint, values (array
    in the order of ``tracked``; in a patch null where nothing changed).
    """
    names = list(tracked)
    plain = rows.select("entity", "as_of", F.lit(None).cast("int").alias("base"), *[F.col(f"row.v{i}").alias(f"v{i}") for i in range(len(names))])
    if base is not None:
        plain = plain.unionByName(base.select("entity", F.lit(None).cast(dict(rows.dtypes)["as_of"]).alias("as_of"), F.col("seq").cast("int").alias("base"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(names)]))
    order = Window.partitionBy("entity").orderBy(F.col("base").isNull(), "as_of")
    past, until = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    known = plain.select("*", F.row_number().over(order).alias("n"), *[F.last(f"v{i}", ignorenulls=True).over(past).alias(f"p{i}") for i in range(len(names))])
    differs = [F.col(f"v{i}").isNotNull() & (F.col(f"p{i}").isNull() | (comparable(c, F.col(f"v{i}")) != comparable(c, F.col(f"p{i}")))) for i, c in enumerate(names)]
    known = known.withColumns({f"d{i}": d for i, d in enumerate(differs)})
    taught = known.filter((F.col("n") == 1) | _any([F.col(f"d{i}") for i in range(len(names))]))
    seq = F.coalesce(F.first("base").over(until), F.lit(1)) + F.row_number().over(order) - 1
    numbered = taught.withColumn("seq", seq).withColumn("is_checkpoint", (F.col("seq") - 1) % F.lit(every) == 0)
    # a checkpoint repeats the last stored spelling of unchanged values
    stored = numbered.withColumns({f"s{i}": F.last(F.when(F.col(f"d{i}"), F.col(f"v{i}")), ignorenulls=True).over(until) for i in range(len(names))})
    values = F.array(*[F.when(F.col("is_checkpoint"), F.col(f"s{i}")).otherwise(F.when(F.col(f"d{i}"), F.col(f"v{i}"))) for i in range(len(names))])
    return stored.filter(F.col("base").isNull()).select("entity", "seq", "as_of", "is_checkpoint", values.alias("values"))


def _any(columns: list[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out | c
    return out


def build_log(snapshots: DataFrame, key: str = "cik", as_of: str = "snapshot_date", loaded: str = "loaded_at", tracked: Sequence[str] = TRACKED, every: int = 8) -> DataFrame:
    """The checkpoint-delta log of periodic snapshots; see :func:`deliveries` and :func:`log_entries`.  Extra columns are ignored."""
    return log_entries(deliveries(snapshots, key, as_of, loaded, tracked), tracked, every)


def fold(log: DataFrame, tracked: Sequence[str] = TRACKED, every: int = 8) -> DataFrame:
    """Every entry of the log with its full state, by folding patches from the nearest checkpoint."""
    order = Window.partitionBy("entity", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    blocks = log.withColumn("block", F.floor((F.col("seq") - 1) / F.lit(every)))
    return blocks.select("entity", "seq", "as_of", *[F.last(F.col("values")[i], ignorenulls=True).over(order).alias(c) for i, c in enumerate(tracked)])


def validity(log: DataFrame, key: str = "cik", tracked: Sequence[str] = TRACKED, every: int = 8) -> DataFrame:
    """One row per version: key, attributes, valid_from, valid_to (exclusive; null while current), version_no.

    An entry opens a version if a value known before differs in its folded state.
    A value first learnt within a version belongs to that version.
    """
    order = Window.partitionBy("entity").orderBy("seq")
    state = fold(log, tracked, every).select("*", *[F.lag(c).over(order).alias(f"_before{i}") for i, c in enumerate(tracked)])
    moved = [F.coalesce(comparable(c, F.col(c)) != comparable(c, F.col(f"_before{i}")), F.lit(False)) for i, c in enumerate(tracked)]
    opened = state.withColumn("_opens", ((F.col("seq") == 1) | _any(moved)).cast("int"))
    numbered = opened.withColumn("version_no", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    versions = numbered.groupBy("entity", "version_no").agg(F.min("as_of").alias("valid_from"), *[F.max_by(c, "seq").alias(c) for c in tracked])
    return versions.select(
        F.col("entity").alias(key), *tracked, "valid_from",
        F.lead("valid_from").over(Window.partitionBy("entity").orderBy("version_no")).alias("valid_to"),
        F.col("version_no").cast("int").alias("version_no"),
    )


def state_at(log: DataFrame, when: str | None, key: str = "cik", tracked: Sequence[str] = TRACKED, every: int = 8) -> DataFrame:
    """Each entity's known state at ``when``, or now: the nearest checkpoint at or before it and the patches since.

    Columns: key, known_since (date of the last entry), seq (its number), attributes.
    """
    seen = log if when is None else log.filter(F.col("as_of") <= F.lit(when))
    newest = seen.groupBy("entity").agg(F.max(F.when(F.col("is_checkpoint"), F.col("seq"))).alias("base"))
    tail = seen.join(newest, "entity").filter(F.col("seq") >= F.col("base"))
    per = [F.max(F.when(F.col("values")[i].isNotNull(), F.struct(F.col("seq"), F.col("values")[i].alias("v")))).getField("v").alias(c) for i, c in enumerate(tracked)]
    return tail.groupBy("entity").agg(F.max("as_of").alias("known_since"), F.max("seq").alias("seq"), *per).withColumnRenamed("entity", key)


def entity_history(snapshots: DataFrame, every: int = 8, **options) -> DataFrame:
    """Snapshots to validity rows through a written checkpoint-delta log."""
    tracked, key = options.get("tracked", TRACKED), options.get("key", "cik")
    return validity(materialise(build_log(snapshots, every=every, **options), "history"), key, tracked, every)


class HistoryStore:
    """A checkpoint-delta log kept in a folder of any Hadoop file system.

    Every append writes its deliveries and log entries aside and commits them by
    one rename, so an append that dies leaves nothing behind.  Entities whose new
    snapshots are all later than those held go on from their state at the nearest
    checkpoint.  One with a late or corrected snapshot is written anew from its
    deliveries, under the number of the append; readers take an entity's entries
    of the highest such number.  After ``compact_every`` appends the folders are
    rewritten as one.
    """

    def __init__(self, spark: SparkSession, root: str, tracked: Sequence[str] = TRACKED, every: int = 8, compact_every: int = 32, **options):
        self.spark, self.commits = spark, CommitLog(spark, root)
        self.tracked, self.every, self.compact_every, self.options = list(tracked), every, compact_every, options

    def _live(self) -> list[str]:
        last = self.commits.last()
        return last["live"] if last else []

    def _read(self, part: str, live: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{folder}/{part}" for folder in live])

    def log(self, live: list[str] | None = None) -> DataFrame | None:
        """The entries in force; None before the first append."""
        live = self._live() if live is None else live
        if not live:
            return None
        held = self._read("log", live).withColumn("_in_force", F.max("written").over(Window.partitionBy("entity")))
        return held.filter(F.col("written") == F.col("_in_force")).drop("_in_force")

    def append(self, snapshots: DataFrame) -> dict:
        """Add snapshots, in any order and also ones already held; returns the commit."""
        last, live = self.commits.last(), self._live()
        number = last["number"] + 1 if last else 1
        new = materialise(deliveries(snapshots, tracked=self.tracked, **self.options), "deliveries")
        if live:
            entries = self._entries(new, live, number)
        else:
            entries = log_entries(new, self.tracked, self.every).withColumn("written", F.lit(number))
        folder = f"{self.commits.root}/data/{number:012d}-{uuid.uuid4().hex}"
        if len(live) + 1 >= self.compact_every:
            held = materialise(entries, "entries")
            every = self._read("log", live).unionByName(held)
            every = every.withColumn("_in_force", F.max("written").over(Window.partitionBy("entity"))).filter(F.col("written") == F.col("_in_force")).drop("_in_force")
            every.write.parquet(f"{folder}/log")
            _latest(self._read("deliveries", live).unionByName(new)).write.parquet(f"{folder}/deliveries")
            live = [folder]
        else:
            entries.write.parquet(f"{folder}/log")
            new.write.parquet(f"{folder}/deliveries")
            live = [*live, folder]
        entry = {"number": number, "data": folder, "live": live}
        self.commits.commit(number, entry)
        return entry

    def _entries(self, new: DataFrame, live: list[str], number: int) -> DataFrame:
        touched = new.groupBy("entity").agg(F.min("as_of").alias("first"))
        held = self._read("deliveries", live)
        until = held.join(touched, "entity", "left_semi").groupBy("entity").agg(F.max("as_of").alias("until"))
        placed = materialise(touched.join(until, "entity", "left").select("entity", (F.col("first") <= F.col("until")).alias("late")), "touched")
        late = placed.filter(F.col("late"))
        rebuilt = _latest(held.join(late, "entity", "left_semi").unionByName(new.join(late, "entity", "left_semi")))
        anew = log_entries(rebuilt, self.tracked, self.every).withColumn("written", F.lit(number))
        ahead = placed.filter(~F.coalesce("late", F.lit(False)))
        log = self.log(live).join(ahead, "entity", "left_semi")
        base = state_at(log, None, "entity", self.tracked, self.every)
        onward = log_entries(new.join(ahead, "entity", "left_semi"), self.tracked, self.every, base)
        since = log.groupBy("entity").agg(F.max("written").alias("written"))
        onward = onward.join(since, "entity", "left").withColumn("written", F.coalesce("written", F.lit(number)))
        return anew.unionByName(onward.select(anew.columns))

    def versions(self, key: str = "cik") -> DataFrame | None:
        """Validity rows of all entities; None before the first append."""
        log = self.log()
        return None if log is None else validity(log, key, self.tracked, self.every)

    def at(self, when: str | None = None, key: str = "cik") -> DataFrame | None:
        """The known state of each entity at a date, or now; None before the first append."""
        log = self.log()
        return None if log is None else state_at(log, when, key, self.tracked, self.every)
