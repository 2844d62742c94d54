"""Mixing sources to target weights by iterative proportional fitting, then calibrated sampling.

Documents fall into cells (source, language, topic).  Raking scales the cells'
token weights to one marginal after the other until all three hold or the
weights stop changing.  Up to ``CELLS_HERE`` cells are raked in the driver (a
few numbers a cell); more are raked as a table, every step of which sums a
marginal with map-side combine and joins the factors back, so no group of cells
gathers anywhere, and is written to the shared folder.

With ``keep``, the share of the tokens that the sample is to hold, a cell's
probability is its raked weight, at most 1: of a marginal, cells that reach 1
stay there and the others carry the rest of the goal.  A value too rare for its
goal is kept whole and the other values share what it lacks, so no rare cell
steers the others.  Targets may contradict one another under that limit; no cell
then falls under a tenth of what its own three targets ask for, and the
remaining error is reported.  Without ``keep`` the weights are divided by the
largest one: the shares are exact, but the rarest cell sets how much is kept.

A document is kept if a hash of its id and text, read as a number in [0, 1),
lies under its cell's probability.  ``mixed_cells`` returns the kept share and
the largest relative error of a marginal, and both are logged, as a warning if
the goals were not met.

Only DataFrame operations touch documents.  Null sources, languages and topics
are values of their own; null and empty texts have no tokens, lie in the topic
``empty`` and are kept (they carry no tokens to weigh).  Repeated rows are kept
or dropped together.  A target that names a value with no document is
renormalised over the others; a value that a target leaves out or gives nothing
gets no weight.  The caller's columns stay in one struct meanwhile.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import columns_of, drop_scratch, scratch_table

DIMENSIONS = ("source", "lang", "topic")
TEMPER = {"source": 0.85, "lang": 0.85, "topic": 0.9}
#: Share of the tokens that the query and the pipeline keep.
KEEP = 0.75
#: Cells that are raked in the driver; more are raked as a table.
CELLS_HERE = 50_000
TOLERANCE = 1e-6
STILL = 1e-12  # weights that change by less in a sweep have stopped
HIGHEST = 1e9  # of a cell whose probability is 1 anyway

log = logging.getLogger(__name__)


@dataclass
class Report:
    """What a mix keeps: share of all tokens expected, largest relative error of a marginal, sweeps done."""

    kept_share: float
    error: float
    sweeps: int


def topic_of(text: Column) -> Column:
    """A topic by plain rules on the whole text, first match."""
    low = F.lower(text)
    has = lambda *words: F.array_max(F.array(*[low.contains(w) for w in words], F.lit(False)))
    return (
        F.when(text.isNull() | ~text.rlike(r"[^\x20\x09-\x0D]"), "empty")
        .when(has("license", "licence", "copyright", "warranty"), "legal")
        .when(has("@", "http://", "https://", "www."), "contact")
        .when(has(" | "), "table")
        .when(text == F.upper(text), "shouting")
        .when(F.length(text) < 500, "short")
        .when(F.length(text) < 4000, "article")
        .otherwise("long")
    )


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("double")


def unit_hash(*columns: Column, seed: int) -> Column:
    """A number in [0, 1) from the columns' hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") / F.lit(float(1 << 53))


def _category(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def cells_of(docs: DataFrame, topic: Column) -> DataFrame:
    """(source_mix, lang_mix, topic_mix, n_mix): tokens of every cell."""
    by = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic}
    rows = docs.select(*[_category(c).alias(f"{d}_mix") for d, c in by.items()], token_count(F.col("text")).alias("t"))
    return rows.groupBy(*[f"{d}_mix" for d in DIMENSIONS]).agg(F.sum("t").alias("n_mix"))


def _given(cells: DataFrame, dimension: str, shares: dict[str | None, float]) -> DataFrame:
    return cells.sparkSession.createDataFrame([("null" if k is None else f"={k}", float(v)) for k, v in shares.items()], f"{dimension}_mix string, raw double")


def targets_of(cells: DataFrame, dimension: str, shares: dict[str | None, float] | None, temper: float, keep: float | None = None) -> DataFrame:
    """(``dimension``_mix, goal, pull_mix): tokens each value should weigh, also by present token; default: present shares raised to ``temper``.

    With ``keep`` the goals sum to that share of the tokens, and no goal exceeds what its value has.
    """
    column = f"{dimension}_mix"
    sums = cells.groupBy(column).agg(F.sum("n_mix").alias("n")).filter("n > 0")
    if shares is None:
        sums = sums.withColumn("raw", F.pow("n", F.lit(temper)))
    else:
        sums = sums.join(_given(cells, dimension, shares), column)
    total = sums.agg(F.sum("n"), F.sum("raw")).first()
    per_raw = (total[0] or 0.0) * (1.0 if keep is None else keep) / (total[1] or 1.0)
    goal = F.col("raw") * F.lit(per_raw)
    if keep is not None:
        sums, path = scratch_table(sums, "mix-sums")
        budget, whole = (total[0] or 0.0) * keep, -1
        while True:  # values kept whole only become more, so this ends
            full = F.col("n") <= F.col("raw") * F.lit(per_raw)
            r = sums.agg(F.count_if(full), F.sum(F.when(full, F.col("n"))), F.sum(F.when(~full, F.col("raw")))).first()
            if r[0] == whole or not r[2]:
                break
            whole, per_raw = r[0], max(per_raw, (budget - (r[1] or 0.0)) / r[2])
        goal = F.when(full, F.col("n")).otherwise(F.col("raw") * F.lit(per_raw))
    return sums.withColumn("goal", goal).select(column, "goal", (F.col("goal") / F.col("n")).alias("pull_mix"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], *, keep: float | None = None, sweeps: int = 1000, tolerance: float = TOLERANCE, cells_here: int = CELLS_HERE) -> tuple[DataFrame, float, int]:
    """``cells`` with w_mix, such that the sum of n_mix * w_mix by each dimension meets its target; the largest relative error that remains; the sweeps.

    With ``keep``, the sums are of n_mix * least(w_mix, 1).
    """
    cells = cells.withColumn("low_mix", F.lit(0.0 if keep is None else keep))
    for d in DIMENSIONS:  # what the cell's own targets ask for
        cells = cells.join(targets[d].select(f"{d}_mix", "pull_mix"), f"{d}_mix", "left")
        cells = cells.withColumn("low_mix", F.col("low_mix") * F.coalesce("pull_mix", F.lit(0.0)) / F.lit(keep or 1.0)).drop("pull_mix")
    cells = cells.withColumns({"low_mix": F.least("low_mix", F.lit(1.0)) * 0.1, "w_mix": F.lit(1.0)})
    cells, path = scratch_table(cells, "mix-cells")
    if cells.count() <= cells_here:
        done, error, k = _rake_here(cells, targets, keep is not None, sweeps, tolerance)
    else:
        done, error, k = _rake_table(cells, path, targets, keep is not None, sweeps, tolerance)
    return done.drop("low_mix"), error, k


def _rake_here(cells: DataFrame, targets: dict[str, DataFrame], limited: bool, sweeps: int, tolerance: float) -> tuple[DataFrame, float, int]:
    rows = cells.collect()
    n = np.array([r["n_mix"] for r in rows], float)
    low = np.array([r["low_mix"] for r in rows], float)
    some = n > 0
    marginals = []
    for d in DIMENSIONS:
        goal_of = {r[0]: r["goal"] for r in targets[d].collect()}
        place: dict[str, int] = {}
        at = np.array([place.setdefault(r[f"{d}_mix"], len(place)) for r in rows], int)
        marginals.append((at, np.array([goal_of.get(v, 0.0) for v in place], float)))
    w, error, k = np.ones(len(rows)), 0.0, 0
    got = lambda at, goal, x: np.bincount(at, x, len(goal))
    used = lambda: np.minimum(w, 1.0) if limited else w
    for k in range(1, sweeps + 1):
        before = used().copy()
        for at, goal in marginals:
            have = got(at, goal, n * w)
            w = np.where(some, w * np.where(have > 0, goal / np.where(have > 0, have, 1.0), 1.0)[at], 1.0)
            # what cells over 1 cannot carry goes to the others; the factor only grows, up to the exact one
            for _ in range(50 if limited else 0):
                full = w >= 1
                rest, free = goal - got(at, goal, n * full), got(at, goal, n * w * ~full)
                f = np.where((free > 0) & (rest > free), rest / np.where(free > 0, free, 1.0), 1.0)
                w = np.where(some, w * f[at], 1.0)
                if f.max(initial=1.0) < 1 + STILL:
                    break
            if limited:
                w = np.where(some, np.clip(w, low, HIGHEST), 1.0)
        error = max((float(np.max(np.abs(got(at, goal, n * used()) - goal)[goal > 0] / goal[goal > 0], initial=0.0)) for at, goal in marginals), default=0.0)
        if error < tolerance or np.all(np.abs(used() - before) <= STILL * before):
            break
    out = {c: pa.array([r[c] for r in rows], pa.float64() if c in ("n_mix", "low_mix") else pa.string()) for c in cells.columns if c != "w_mix"}
    out["w_mix"] = pa.array(w, pa.float64())
    return scratch_table(cells.sparkSession.createDataFrame(pa.table(out)), "mix-cells")[0], error, k


def _rake_table(now: DataFrame, path: str, targets: dict[str, DataFrame], limited: bool, sweeps: int, tolerance: float) -> tuple[DataFrame, float, int]:
    spark, error, k = now.sparkSession, 0.0, 0
    weigh = F.col("n_mix") * F.col("w_mix")
    now = now.withColumn("was_mix", F.col("w_mix"))
    used = lambda c: F.least(F.col(c), F.lit(1.0)) if limited else F.col(c)
    for k in range(1, sweeps + 1):
        for d in DIMENSIONS:
            column = f"{d}_mix"
            full = F.col("w_mix") >= (1.0 if limited else float("inf"))
            sums = now.groupBy(column).agg(F.sum(weigh).alias("got"), F.sum(F.when(full, F.col("n_mix")).otherwise(0.0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(weigh)).alias("free"))
            some = (F.col("free") > 0) & (F.col("goal") > F.col("full"))
            # the cells over 1 carry 1 each, the others the rest of the goal; where all are over 1, the goal as a whole
            ratio = F.when(some, (F.col("goal") - F.col("full")) / F.col("free")).when(F.col("full") >= F.col("goal") * (1 + 1e-9), F.col("goal") / F.col("got")).otherwise(1.0)
            factor = sums.join(targets[d], column).filter("got > 0").select(column, ratio.alias("f"))
            # cells without tokens keep their weight; a value that the target leaves out gets none
            step = now.join(factor, column, "left").withColumn("f", F.when(F.col("n_mix") > 0, F.coalesce("f", F.lit(0.0))).otherwise(1.0))
            if d == DIMENSIONS[0]:
                step = step.withColumn("was_mix", F.col("w_mix"))
            after = F.col("w_mix") * F.col("f")
            if limited:
                after = F.when(F.col("n_mix") > 0, F.least(F.greatest(after, F.col("low_mix")), F.lit(HIGHEST))).otherwise(1.0)
            # written after every marginal: the plan of a step holds that step alone
            now, new_path = scratch_table(step.withColumn("w_mix", after).drop("f"), "mix-cells")
            drop_scratch(spark, path)
            path = new_path
        error = 0.0
        for d in DIMENSIONS:
            have = now.groupBy(f"{d}_mix").agg(F.sum(F.col("n_mix") * used("w_mix")).alias("got")).join(targets[d], f"{d}_mix").filter("goal > 0")
            error = max(error, have.agg(F.max(F.abs(F.col("got") - F.col("goal")) / F.col("goal"))).first()[0] or 0.0)
        moved = now.filter(F.abs(used("w_mix") - used("was_mix")) > STILL * used("was_mix"))
        if error < tolerance or moved.isEmpty():
            break
    return now.drop("was_mix"), error, k


def mixed_cells(cells: DataFrame, *, shares: dict[str, dict] | None = None, keep: float | None = None, sweeps: int = 1000, cells_here: int = CELLS_HERE) -> tuple[DataFrame, Report]:
    """``cells`` (of ``cells_of``) with w_mix (the weight of a token) and p_mix, and what they keep."""
    shares = shares or {}
    total = cells.agg(F.sum("n_mix")).first()[0] or 0.0
    aimed = cells
    if keep is not None:
        if not 0 < keep <= 1:
            raise ValueError(f"keep is a share of the tokens, not {keep}")
        for d in shares:  # the budget is met by what all targets name
            aimed = aimed.join(_given(cells, d, shares[d]).filter("raw > 0"), f"{d}_mix", "left_semi")
    targets = {d: scratch_table(targets_of(aimed, d, shares.get(d), TEMPER[d], keep), "mix-target")[0] for d in DIMENSIONS}
    weights, error, done = rake(cells, targets, keep=keep, sweeps=sweeps, cells_here=cells_here)
    if keep is None:
        top = weights.filter("n_mix > 0").agg(F.max("w_mix")).first()[0] or 1.0
        chance = F.col("w_mix") / F.lit(top)
    else:
        chance = F.col("w_mix")
    weights = weights.withColumn("p_mix", F.least(F.lit(1.0), F.when(F.col("n_mix") > 0, chance).otherwise(1.0)))
    if keep is not None:
        weights = weights.withColumn("w_mix", F.when(F.col("n_mix") > 0, F.col("p_mix") / F.lit(keep)).otherwise(1.0))
    kept = weights.agg(F.sum(F.col("n_mix") * F.col("p_mix"))).first()[0] or 0.0
    report = Report(kept / total if total else 1.0, error, done)
    say = log.info if error < TOLERANCE else log.warning
    say("mix: %.4f of the tokens kept, marginals met to %.2g after %d sweeps", report.kept_share, error, done)
    return weights, report


def mix(docs: DataFrame, *, shares: dict[str, dict] | None = None, topic: Column | None = None, seed: int = 42, sweeps: int = 1000, keep: float | None = None) -> DataFrame:
    """``docs`` with topic_mix, n_mix (the cell's tokens), w_mix, p_mix and kept_mix.

    ``shares``: target token shares by dimension, e.g. {"lang": {"en": 0.5, "de": 0.5}}; a dimension
    left out gets its present shares raised to a power under 1, which lifts small sources.
    ``keep``: share of the tokens to keep, of those that no target excludes.
    Columns of ``docs`` with the names of the five new ones are replaced; ``mixed_rows`` keeps the caller's columns apart.
    """
    out = mixed_rows(docs, shares=shares, topic=topic, seed=seed, sweeps=sweeps, keep=keep)
    return out.select(*[F.col("r").getField(c).alias(c) for c in docs.columns if c not in MIXED], *MIXED)


#: What the mix says about a row.
MIXED = ("topic_mix", "n_mix", "w_mix", "p_mix", "kept_mix")


def mixed_rows(docs: DataFrame, *, shares: dict[str, dict] | None = None, topic: Column | None = None, seed: int = 42, sweeps: int = 1000, keep: float | None = None) -> DataFrame:
    """Rows of ``docs`` as the struct r, with the columns that ``mix`` adds."""
    topic = topic_of(F.col("text")) if topic is None else topic
    cells, path = scratch_table(cells_of(docs, topic), "mix-count")
    weights, _ = mixed_cells(cells, shares=shares, keep=keep, sweeps=sweeps)
    # the caller's columns stay in one struct, so their names meet none of these
    keyed = docs.select(
        F.struct(*columns_of(docs)).alias("r"), _category(F.col("source")).alias("source_mix"), _category(F.col("lang")).alias("lang_mix"), _category(topic).alias("topic_mix")
    )
    # cells number sources x languages x topics; Spark broadcasts them if their written size is small, else joins by shuffle
    out = keyed.join(weights, [f"{d}_mix" for d in DIMENSIONS])
    chance = unit_hash(F.col("r.doc_id"), F.col("r.text"), seed=seed)
    return out.select("r", *MIXED[:-1], (chance < F.col("p_mix")).alias("kept_mix"))


def sample_mixed(docs: DataFrame, *, shares: dict[str, dict] | None = None, seed: int = 42, sweeps: int = 1000, keep: float | None = KEEP) -> DataFrame:
    """The rows of ``docs`` that the mix keeps, columns unchanged."""
    return mixed_rows(docs, shares=shares, seed=seed, sweeps=sweeps, keep=keep).filter("kept_mix").select("r.*")
