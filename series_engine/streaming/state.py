"""Series features and scores that go on across micro-batches.

Row windows are not possible on a stream, and a window that restarts with every
micro-batch loses the first rows of each.  Here each entity leaves a *halo* behind:
the last ``period + n`` rows of its current run (all that a later row's averages
and lags can reach), with the run's id and length.  A batch is worked on together
with the halos of its entities, so a stream cut anywhere gives the rows of one
batch job over all of it: run ids, averages, lags and stride ranks continue.

State is a log (``sinks.commits``).  A batch writes its rows and the halos of its
own entities, then one record that names both; until the record is there the batch
has not happened.  A batch that is run again (the driver died before Spark noted
it) finds the state of the batch before, whatever the first attempt left; one that
was recorded does nothing.  An entity's halo is the one of the last batch that had
rows of it; every ``snapshot_every`` batches the halos of all entities are written
as one snapshot, so a batch reads one snapshot and few deltas.  ``compact`` merges
old batches by levels, so neither folders nor records grow with the batches.

Everything is DataFrame code.  A batch in which every entity has few rows is shuffled
by entity once, together with the halos, and its windows follow each other on that
(``_advance_whole``); otherwise windows run over chunks and blocks of an entity as in
batch jobs (``operators.sequence``), so an entity that fills a batch is no hot task.
Halos are small for every entity.

Rows must arrive in order: those of a batch lie after all earlier rows of their
entity.  Rows at or before the entity's last order values are *late*; they are kept
aside in the ``late`` folders of the log, not dropped.  Rows with NULL in a feature
column, entity or label are not part of a series (as behind ``DropIncomplete``)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import sequence
from ..operators.joins import join_small, materialize_small
from ..operators.sequence import BLOCK, ESTART, HALO, PEER, POS
from ..sinks.commits import CommitLog
from .jobs import trigger_kwargs


@dataclass
class Chain:
    """What the feature chain of a stream computes (as ``features.event_features``)."""

    cols: list
    by: list
    order: list
    label: str
    period: int
    n: int
    step: int
    event_col: str = "event"
    suffix: str = "_lags"
    rank_col: str | None = "rank"
    chunk_width: object = None
    block_rows: int = sequence.DEFAULT_BLOCK_ROWS
    unique_order: bool = False

    @property
    def reach(self) -> int:
        return int(self.period) + int(self.n)


_RUN, _LEN, _BACK, _BATCH = "_run", "_run_len", "_back", "_batch"


class HaloState:
    """The halos of a stream's entities, as committed up to a batch."""

    def __init__(self, spark: SparkSession, base: str, chain: Chain, snapshot_every: int = 20):
        self.log, self.chain, self.snapshot_every = CommitLog(spark, base), chain, int(snapshot_every)

    def _folders(self, before: int) -> list[str]:
        """State folders in force before a batch: the last snapshot and what followed."""
        records = sorted((r for r in self.log.records() if "state" in r["folders"] and r["batch"] < before), key=lambda r: r["batch"])
        last = max((i for i, r in enumerate(records) if r["snapshot"]), default=0)
        return [r["folders"]["state"] for r in records[last:]]

    def stored(self, batch: int) -> DataFrame | None:
        """Halo rows in force before a batch and older ones of the same entities; None at the start."""
        paths = self._folders(batch)
        return self.log.spark.read.parquet(*paths) if paths else None

    def before(self, batch: int) -> DataFrame | None:
        """Halo rows of every entity as of the batch before; None at the start."""
        rows = self.stored(batch)
        if rows is None:
            return None
        # an entity has at most ``reach`` rows in a folder, and few folders are read
        newest = F.max(_BATCH).over(Window.partitionBy(*self.chain.by))
        return rows.withColumn("_newest", newest).where(F.col(_BATCH) == F.col("_newest")).drop("_newest")

    def is_snapshot(self, batch: int) -> bool:
        return batch % self.snapshot_every == self.snapshot_every - 1


def _same(by, left: DataFrame, right: DataFrame) -> Column:
    cond = F.lit(True)
    for b in by:
        cond = cond & (left[b] == right[f"_k_{b}"])
    return cond


def _whole_rows(batch: DataFrame, c: Chain) -> DataFrame:
    """The rows that are part of a series."""
    whole = F.lit(True)
    for name in [*c.by, *c.order, c.label, *c.cols]:
        whole = whole & F.col(name).isNotNull()
    for name in c.cols:
        if batch.schema[name].dataType.typeName() in ("double", "float"):
            whole = whole & ~F.isnan(name)
    return batch.where(whole)


def _fits_whole(batch: DataFrame, c: Chain) -> bool:
    """Whether no entity has more rows in the batch than one window may hold."""
    width, most = c.chunk_width, int(c.block_rows)
    if width is None or width == "auto":
        most = min(most, sequence.AUTO_CHUNK_ROWS)
    elif str(width).startswith("rows:"):
        most = min(most, int(str(width)[5:]))
    elif width != 0:
        return False
    per = batch.groupBy(*c.by).agg(F.count(F.lit(1)).alias("n"))
    return (per.agg(F.max("n")).first()[0] or 0) <= most


def _advance_whole(batch: DataFrame, stored: DataFrame | None, chain: Chain, batch_id: int, carry: bool,
                   keep_once: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """As ``advance`` for a batch whose entities fit one window each, with the rows
    of all state folders in force: one shuffle by entity brings rows and halos
    together, and the rows that go on (features, halos, late rows) are kept once.
    The new halos have their batch; with ``carry`` those of all other entities
    are among them."""
    c, by, order = chain, list(chain.by), list(chain.order)
    x = _whole_rows(batch, c)
    names, keys = x.columns, by
    struct = F.struct(*order)
    if stored is None:
        x = x.withColumns({"_old": F.lit(False), "_run0": F.lit(0).cast("long"), "_before": F.lit(0).cast("long"),
                           _BATCH: F.lit(None).cast("long"), "_late": F.lit(False)})
    else:
        facts = [_BATCH, _RUN, _LEN, _BACK]
        x = x.select(*names, F.lit(False).alias("_old"), *[F.lit(None).cast("long").alias(f) for f in facts]).unionByName(
            stored.select(*names, F.lit(True).alias("_old"), *[F.col(f).cast("long").alias(f) for f in facts]))
        e = Window.partitionBy(*by)
        # runs and batches grow; the halo of a batch has one run and one length, and its rows are counted back from 0
        x = x.withColumns({"_tip": F.max(F.struct(*facts)).over(e), "_last": F.max(F.when(F.col("_old"), struct)).over(e),
                           "_any": F.max(~F.col("_old")).over(e)})
        x = x.where(~F.col("_old") | ((F.col(_BATCH) == F.col(f"_tip.{_BATCH}")) & (F.col("_any") | F.lit(carry))))
        zero = F.lit(0).cast("long")
        x = x.select(*names, "_old", F.coalesce(f"_tip.{_RUN}", zero).alias("_run0"),
                     F.coalesce(F.col(f"_tip.{_LEN}") - F.col(f"_tip.{_BACK}") - 1, zero).alias("_before"),
                     F.when(~F.col("_any"), F.col(_BATCH)).alias(_BATCH),
                     (~F.col("_old") & F.coalesce(struct <= F.col("_last"), F.lit(False))).alias("_late"))
        keys = [*by, "_late"]  # late rows stand beside the series
    ties = []
    if not c.unique_order:
        x = x.withColumn("_tb", sequence.row_tiebreak(x.select(*names, "_old", "_run0", "_before")))
        ties = ["_tb"]
    w = Window.partitionBy(*keys).orderBy(*order, *ties)
    wr = Window.partitionBy(*keys).orderBy(*order)  # peers share a rank and a run
    x = x.withColumns({"_rn": F.row_number().over(w), "_rk": F.rank().over(wr),
                       "_n": F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
                       "_ind": F.coalesce((F.col(c.label) != F.lag(c.label).over(w)).cast("long"), F.lit(0).cast("long"))})
    x = x.withColumn("_ev", F.sum("_ind").over(wr.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    run = Window.partitionBy(*keys, "_ev").orderBy("_rn")
    all_run = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    means = [f"_mean{i}" for i in range(len(c.cols))]
    x = x.withColumns({"_first": F.min("_rn").over(all_run), "_end": F.max("_rn").over(all_run),
                       **{m: F.avg(a).over(run.rowsBetween(-int(c.period), Window.currentRow)) for m, a in zip(means, c.cols)}})
    # no column holds a NULL here: one list of all columns' values, taken apart in the rows that stay
    x = x.withColumn("_lags", F.collect_list(F.struct(*means)).over(run.rowsBetween(-int(c.n), -1)))
    skipped = F.when(F.col("_ev") == 0, F.col("_before")).otherwise(F.lit(0).cast("long"))  # rows of the run before the halo
    rank = (F.col("_rk") - F.col("_first") + skipped - F.lit(int(c.n)) + 1).cast("int")
    made = ~F.col("_old") & ~F.col("_late") & (rank > 0) & (rank % F.lit(int(c.step)) == 0) & (F.size("_lags") == int(c.n))
    left = ~F.col("_late") & (F.col("_end") == F.col("_n")) & (F.col("_rn") > F.col("_n") - F.lit(c.reach))
    x = x.withColumns({"_made": made, "_left": left}).where("_made OR _left OR _late")
    z = keep_once(x.select(
        *names, *means, *[F.when(F.col("_made"), F.reverse(F.col("_lags").getField(m))).alias(f"{a}{c.suffix}") for m, a in zip(means, c.cols)],
        (F.col("_run0") + F.col("_ev")).alias(_RUN), (F.col("_n") - F.col("_first") + 1 + skipped).cast("long").alias(_LEN),
        (F.col("_n") - F.col("_rn")).cast("long").alias(_BACK), _BATCH, rank.alias("_rank"), "_made", "_left", "_late"))
    mean = dict(zip(c.cols, means))
    features = z.where("_made").select(
        *[F.col(mean[a]).alias(a) if a in mean else F.col(a) for a in names], F.col(_RUN).alias(c.event_col),
        *[f"{a}{c.suffix}" for a in c.cols], *([F.col("_rank").alias(c.rank_col)] if c.rank_col else []))
    late = z.where("_late").select(*names) if stored is not None else None
    # the batch's number comes last: the code made for the plan above is that of every batch
    halos = z.where("_left").select(*names, _RUN, _LEN, _BACK, F.coalesce(_BATCH, F.lit(int(batch_id)).cast("long")).alias(_BATCH))
    return features, halos, late


def advance(batch: DataFrame, halo: DataFrame | None, chain: Chain,
            keep_once: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """``(features, new halos, late rows)`` of a batch, given the halos before it
    (None for late rows: there can be none yet).  The halos of the batch's entities,
    the rows beside them and the numbered rows are read several times and go through
    ``keep_once``."""
    c, by, order = chain, list(chain.by), list(chain.order)
    rows = _whole_rows(batch, c)
    names = rows.columns
    if halo is None:
        late = None
        x = rows.withColumns({"_old": F.lit(False), "_run0": F.lit(0).cast("long"), "_before": F.lit(0).cast("long")})
    else:
        mine = keep_once(halo.join(rows.select(*by).distinct(), by, "left_semi"))
        last = mine.groupBy(*[F.col(b).alias(f"_k_{b}") for b in by]).agg(
            F.max(F.struct(*order)).alias("_last"), F.max(_RUN).alias("_run0"),
            (F.max(_LEN) - F.count(F.lit(1))).alias("_before"))
        local = materialize_small(last)
        last = F.broadcast(local) if local is not None else keep_once(last)
        known = keep_once(rows.join(last, _same(by, rows, last), "left"))
        is_late = F.coalesce(F.struct(*order) <= F.col("_last"), F.lit(False))
        late = known.where(is_late).select(*names)
        fresh = known.where(~is_late).select(
            *names, F.lit(False).alias("_old"), F.coalesce("_run0", F.lit(0)).cast("long").alias("_run0"),
            F.coalesce("_before", F.lit(0)).cast("long").alias("_before"))
        # halos of entities that have only late rows change nothing, but may stand here
        tail = mine.join(last, _same(by, mine, last), "inner").select(
            *names, F.lit(True).alias("_old"), F.col("_run0").cast("long").alias("_run0"), F.col("_before").cast("long").alias("_before"))
        x = fresh.unionByName(tail)
    y = sequence.index(x, by, order, label=c.label, event_col="_ev", chunk_width=c.chunk_width, unique_order=c.unique_order)
    # rows of the current run that lie before the halo
    y = keep_once(y.withColumn("_skipped", F.when(F.col("_ev") == 0, F.col("_before")).otherwise(F.lit(0).cast("long"))))

    # what the last run of every entity leaves behind
    end = y.groupBy(*[F.col(b).alias(f"_k_{b}") for b in by]).agg(
        F.max(POS).alias("_end"), F.max("_ev").alias("_last_ev"))
    left = join_small(y, end, lambda big, side: _same(by, big, side), "inner")
    left = left.where((F.col("_ev") == F.col("_last_ev")) & (F.col(POS) > F.col("_end") - F.lit(c.reach)))
    state = left.select(*names, (F.col("_run0") + F.col("_ev")).alias(_RUN),
                        (F.col("_end") - F.col(ESTART) + 1 + F.col("_skipped")).alias(_LEN), (F.col("_end") - F.col(POS)).alias(_BACK))

    z = sequence.blocked(y, halo=c.reach, block_rows=c.block_rows)
    w = Window.partitionBy(*by, BLOCK, "_ev").orderBy(POS)
    z = z.withColumns({a: F.avg(F.col(a)).over(w.rowsBetween(-int(c.period), Window.currentRow)) for a in c.cols})
    # no column holds a NULL here: one list of all columns' values, taken apart in the rows that stay
    z = z.withColumn("_se_lags", F.collect_list(F.struct(*[F.col(a).alias(f"c{i}") for i, a in enumerate(c.cols)])).over(w.rowsBetween(-int(c.n), -1)))
    rank = (F.col(PEER) - F.col(ESTART) + F.col("_skipped") - F.lit(int(c.n)) + 1).cast("int")
    keep = ~F.col(HALO) & ~F.col("_old") & (rank > 0) & (rank % F.lit(int(c.step)) == 0)
    keep = keep & (F.size("_se_lags") == int(c.n))
    lags = [F.reverse(F.col("_se_lags").getField(f"c{i}")).alias(f"{a}{c.suffix}") for i, a in enumerate(c.cols)]
    features = z.where(keep).select(*names, (F.col("_run0") + F.col("_ev")).alias(c.event_col), *lags,
                                    *([rank.alias(c.rank_col)] if c.rank_col else []))
    return features, state, late


def process_batch(batch: DataFrame, batch_id: int, state: HaloState, finish: Callable[[DataFrame], DataFrame] | None = None,
                  kind: str = "rows") -> bool:
    """Work on one micro-batch and commit its rows (``finish`` of its features)
    together with its halos; False if it is committed already."""
    log, chain = state.log, state.chain
    if log.committed(batch_id):
        return False
    held: list[DataFrame] = []

    def keep_once(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    try:
        batch = keep_once(batch)
        snapshot, before = state.is_snapshot(batch_id), None
        if _fits_whole(batch, chain):
            made, halos, late = _advance_whole(batch, state.stored(batch_id), chain, batch_id, snapshot, keep_once)
        else:
            before = state.before(batch_id)
            made, halos, late = advance(batch, before, chain, keep_once)
            halos = halos.withColumn(_BATCH, F.lit(int(batch_id)).cast("long"))
        folders = {k: log.attempt(k, batch_id) for k in (kind, "state")}
        (finish(made) if finish else made).write.parquet(folders[kind])
        halos.write.parquet(folders["state"])
        if late is not None and late.limit(1).count():
            folders["late"] = log.attempt("late", batch_id)
            late.write.parquet(folders["late"])
        if snapshot and before is not None:
            written = log.spark.read.schema(halos.schema).parquet(folders["state"])
            rest = before.join(written.select(*chain.by).distinct(), list(chain.by), "left_anti")
            both = written.unionByName(rest.select(*halos.columns))
            folders["state"] = log.attempt("state", batch_id)
            both.hint("rebalance").write.parquet(folders["state"])
        return log.commit(batch_id, folders, batch=int(batch_id), snapshot=snapshot)
    finally:
        for df in held:
            df.unpersist()


#: Bytes of the files that a merge writes.  A folder whose files hold half of that is left as it is.
MERGED_BYTES = 32 << 20


def _merge_rows(log: CommitLog, kind: str, folders: list[str], name: str) -> list[str]:
    """Folders with the rows of these ones: small files are rewritten in files of
    about ``MERGED_BYTES``, without a shuffle; folders of full files are kept."""
    sizes = {f: log.size(f) for f in folders}
    small = [f for f in folders if sizes[f][0] < sizes[f][1] * (MERGED_BYTES // 2) or not sizes[f][1]]
    files = max(1, -(-sum(sizes[f][0] for f in small) // MERGED_BYTES))
    if sum(sizes[f][1] for f in small) <= files:  # no fewer by a rewrite
        return folders
    target = log.attempt(kind, name)
    log.spark.read.parquet(*small).coalesce(files).write.parquet(target)
    return [*(f for f in folders if f not in small), target]


def _merge(state: HaloState, old: list[dict], level: int) -> None:
    """Replace the records of batches in a row by one: their small files rewritten
    in larger ones, and the halos as of the last of them."""
    log, last = state.log, old[-1]["batch"]
    name, folders = f"to-{last}-level-{level}", {}
    for kind in sorted({k for r in old for k in r["folders"]} - {"state"}):
        folders[kind] = _merge_rows(log, kind, [f for r in old for f in log.named(r, kind)], name)
    if old[-1]["snapshot"]:  # these are all halos
        folders["state"] = old[-1]["folders"]["state"]
    else:
        folders["state"] = log.attempt("state", name)
        state.before(last + 1).hint("rebalance").write.parquet(folders["state"])
    replaces = [x for r in old for x in (r["id"], *r.get("replaces", []))]
    if log.commit(name, folders, batch=last, snapshot=True, level=level, replaces=replaces):
        kept = {folders["state"], *(f for kind in folders if kind != "state" for f in folders[kind])}
        for r in old:
            for kind in r["folders"]:
                for folder in log.named(r, kind):
                    if folder not in kept:
                        log._delete(folder)
            log._delete(log._record_path(r["id"]))


def compact(spark: SparkSession, base: str, chain: Chain, fan: int = 8) -> int:
    """Merge the batches of a stream's log; returns the number of merges.

    ``fan`` records of a level become one of the next, oldest first, and the newest
    batch stays: there are at most ``fan`` records a level, a row is rewritten
    once a level until its file is full (``MERGED_BYTES``), and the levels grow with
    the logarithm of the batches.  To be
    called between batches (``features_stream(compact_fan=...)`` does); a merge
    that dies before its record has not happened, one that dies after it leaves
    files that ``CommitLog.sweep`` removes."""
    if fan < 2:
        raise ValueError("a merge takes two records or more")
    state, merges = HaloState(spark, base, chain), 0
    while True:
        records = sorted(state.log.records(), key=lambda r: r["batch"])[:-1]
        levels: dict[int, list[dict]] = {}
        for r in records:
            levels.setdefault(r.get("level", 0), []).append(r)
        full = min((level for level, found in levels.items() if len(found) >= fan), default=None)
        if full is None:
            return merges
        _merge(state, levels[full][:fan], full + 1)
        merges += 1


def features_stream(stream: DataFrame, base: str, chain: Chain, trigger: dict | None = None, snapshot_every: int = 20,
                    finish: Callable[[DataFrame], DataFrame] | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None,
                    kind: str = "rows", compact_fan: int | None = None) -> StreamingQuery:
    """Features of a stream, committed batch by batch under ``base`` (which holds
    the query's checkpoint too, so batch ids and commits belong together).  Read
    them with ``read_rows``.  With ``compact_fan`` the log is compacted after every
    batch that fills a level (see ``compact``)."""
    base = base.rstrip("/")

    def process(batch: DataFrame, batch_id: int) -> None:
        state = HaloState(batch.sparkSession, base, chain, snapshot_every)
        process_batch(prepare(batch) if prepare else batch, batch_id, state, finish, kind)
        if compact_fan:
            compact(batch.sparkSession, base, chain, compact_fan)

    return (stream.writeStream.foreachBatch(process).option("checkpointLocation", f"{base}/_checkpoint")
            .trigger(**(trigger or trigger_kwargs())).start())


def read_rows(spark: SparkSession, base: str, kind: str = "rows", schema=None) -> DataFrame:
    """Rows of all committed batches."""
    return CommitLog(spark, base).read(kind, schema)


def score_stream(stream: DataFrame, model, base: str, trigger: dict | None = None, columns=("userId", "timestamp"),
                 predicted: str = "predicted_action", snapshot_every: int = 20) -> StreamingQuery:
    """Predictions of a fitted activity model for a stream, as one batch job over
    all of it would give them: the model's feature stage runs across batches."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import IndexToString

    from ..operators import features
    from ..plans import model as mdl
    from ..plans.stages import ClassWeightsModel, SeriesFeatures
    stages = [s for s in model.stages if not isinstance(s, ClassWeightsModel)]
    at = next(i for i, s in enumerate(stages) if isinstance(s, SeriesFeatures))
    series, first, rest = stages[at], PipelineModel(stages=stages[:at]), PipelineModel(stages=stages[at + 1:])
    chain = series.chain()
    chain = Chain(**chain, rank_col=None)

    def finish(made: DataFrame) -> DataFrame:
        x = features.assemble(made, [f"{a}{chain.suffix}" for a in chain.cols], series.getOutputCol())
        x = IndexToString(inputCol="prediction", outputCol=predicted, labels=mdl.label_names(model)).transform(rest.transform(x))
        return x.select(*columns, predicted)

    return features_stream(stream, base, chain, trigger, snapshot_every, finish, prepare=first.transform, kind="predictions")
