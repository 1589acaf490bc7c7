"""Boltzmann partition functions over binding sites, by siRNA and in sweeps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duplexa.functions.parameters import DEFAULT_TEMPERATURE, Config, thermal_energy


@dataclass
class Scored:
    """``sites`` with a probability for each config, and ``sums``: one row for each siRNA."""

    sites: DataFrame
    sums: DataFrame


def prepare(sites: DataFrame) -> DataFrame:
    """Missing columns of expression and opening energy get 1 and 0; dG_total is their energy."""
    for name, value in (("exp_value", 1.0), ("opening_energy", 0.0)):
        if name not in sites.columns:
            sites = sites.withColumn(name, F.lit(value))
    return sites.withColumn("dG_total", F.col("energy").cast("double") + F.col("opening_energy").cast("double"))


def altered_energy(config: Config, least: Column) -> Column:
    energy = F.col("energy").cast("double")
    if config.theta is not None:
        return F.lit(config.theta) * (energy + 10.0) - 10.0
    if config.suffix == "":
        return energy
    return F.when(energy < F.lit(config.alpha) * least, F.lit(config.gamma) * least).otherwise(energy)


def weight(config: Config, least: Column, rt: float, opened: bool = True) -> Column:
    """Expression times the Boltzmann factor of the config's energy."""
    energy = altered_energy(config, least)
    if opened:
        energy = energy + F.col("opening_energy").cast("double")
    return F.col("exp_value").cast("double") * F.exp(-energy / F.lit(rt))


def least_energy(sites: DataFrame) -> Column:
    """E_min of the siRNA: of the unfiltered file where raw_e_min is known, of these sites otherwise."""
    return F.min("raw_e_min" if "raw_e_min" in sites.columns else "energy").cast("double").alias("E_min")


def with_least_energy(sites: DataFrame) -> DataFrame:
    return sites.join(sites.groupBy("sirna_id").agg(least_energy(sites)), "sirna_id")


def tag_on_targets(sites: DataFrame, on_targets: DataFrame | None) -> DataFrame:
    """is_on_target: the site's transcript or gene is its siRNA's target. One target a siRNA; the join adds no rows."""
    if on_targets is None:
        return sites.withColumn("is_on_target", F.lit(False))
    return _tagged(sites.join(_one_target(on_targets), "sirna_id", "left"))


def _one_target(on_targets: DataFrame) -> DataFrame:
    return on_targets.groupBy("sirna_id").agg(F.max("target_id").alias("__target"))


def _tagged(sites: DataFrame) -> DataFrame:
    hit = (F.col("transcript_id") == F.col("__target")) | (F.col("gene_id") == F.col("__target"))
    return sites.withColumn("is_on_target", F.coalesce(hit, F.lit(False))).drop("__target")


#: siRNAs whose least energies and targets are sent to all tasks.
SENT_SIRNAS = 200_000


def few_sirnas(sites: DataFrame) -> bool:
    """Whether the sites have at most ``SENT_SIRNAS`` siRNAs; an action over that column."""
    return sites.select("sirna_id").distinct().limit(SENT_SIRNAS + 1).count() <= SENT_SIRNAS


def with_known(sites: DataFrame, least: DataFrame, on_targets: DataFrame, sent: bool) -> DataFrame:
    """Prepared sites with E_min and is_on_target, from ``least``, a row for each of their siRNAs.

    Spark takes an aggregation to be as large as what it adds up, and would shuffle all
    sites by siRNA for the join: ``sent``, after ``few_sirnas``, sends its rows instead.
    """
    known = least.join(_one_target(on_targets), "sirna_id", "left")
    return _tagged(sites.join(F.broadcast(known) if sent else known, "sirna_id"))


def partition_sums(sites: DataFrame, configs: list[Config], rt: float) -> DataFrame:
    """E_min, Z, Z without opening, and on-target weights of every config, in one aggregation by siRNA.

    Clamped configs need E_min in the sites; the others' sums find it on the way.
    """
    least = F.col("E_min") if "E_min" in sites.columns else F.lit(None).cast("double")
    sums = [F.min("E_min").alias("E_min") if "E_min" in sites.columns else least_energy(sites)]
    for config in configs:
        for opened, mark in ((True, ""), (False, "_noacc")):
            w = weight(config, least, rt, opened)
            sums.append(F.sum(w).alias(f"Z_sirna{mark}{config.suffix}"))
            sums.append(F.sum(F.when(F.col("is_on_target"), w).otherwise(0.0)).alias(f"W_on{mark}{config.suffix}"))
    return sites.groupBy("sirna_id").agg(*sums)


def _z(suffix: str) -> Column:
    return F.col(f"`Z_sirna{suffix}`")


def score_by_sirna(
    sites: DataFrame,
    configs: list[Config] | None = None,
    on_targets: DataFrame | None = None,
    temperature: float = DEFAULT_TEMPERATURE,
    external: DataFrame | None = None,
) -> Scored:
    """Probability of each site within its siRNA, for each config, and the sums they come from.

    Sums are an aggregation with partial sums before the shuffle and a row a siRNA after
    it, joined back to the sites: two passes over them, three with clamps. So a siRNA with
    a third of all sites is no single task, as a window over it would be; adaptive
    execution broadcasts the sums while they are small and splits skewed keys when not.

    ``external`` (sirna_id, energy, opening_energy, expression) holds on-target sites found
    elsewhere: tagged rows then leave the sums, and the external weight enters them.
    """
    configs = configs or [Config()]
    rt = thermal_energy(temperature)
    rows = tag_on_targets(prepare(sites), on_targets)
    if external is not None:
        rows = rows.where(~F.col("is_on_target"))
    if external is not None or any(c.theta is None and c.suffix for c in configs):
        rows = with_least_energy(rows)
    if external is not None:
        known = external.groupBy("sirna_id").agg(
            F.min_by(F.struct("energy", "opening_energy", "expression"), "energy").alias("__on")
        )
        rows = rows.join(known, "sirna_id", "left").withColumn("E_min", F.least("E_min", F.col("__on.energy").cast("double"))).drop("__on")
    sums = partition_sums(rows, configs, rt)
    if external is not None:
        sums = _add_external(sums, rows, known, configs, rt)
    return Scored(with_probabilities(rows, sums, configs, rt), sums)


def with_probabilities(rows: DataFrame, sums: DataFrame, configs: list[Config], rt: float) -> DataFrame:
    """Prepared sites with P_off_target for each config; a row of sums for each siRNA is joined."""
    wanted = [_z(c.suffix) for c in configs] + ([] if "E_min" in rows.columns else [F.col("E_min")])
    scored = rows.join(sums.select("sirna_id", *wanted), "sirna_id")
    for c in configs:
        w, z = weight(c, F.col("E_min"), rt), _z(c.suffix)
        scored = scored.withColumn(f"P_off_target{c.suffix}", F.when(z > 0, w / z).otherwise(F.lit(0.0)))
    return scored.drop(*(f"Z_sirna{c.suffix}" for c in configs))


def merged_sums(parts: DataFrame) -> DataFrame:
    """One row a siRNA from sums over parts of its sites: Z and weights add up, of E_min the least counts.

    Right for configs without clamps, whose weights do not depend on other sites.
    """
    return parts.groupBy("sirna_id").agg(
        F.min("E_min").alias("E_min"), *(F.sum(F.col(f"`{c}`")).alias(c) for c in parts.columns if c.startswith(("Z_sirna", "W_on")))
    )


def _add_external(sums: DataFrame, rows: DataFrame, known: DataFrame, configs: list[Config], rt: float) -> DataFrame:
    least = rows.groupBy("sirna_id").agg(F.min("E_min").alias("E_min"))
    on = known.select("sirna_id", "__on.energy", "__on.opening_energy", F.col("__on.expression").alias("exp_value")).join(least, "sirna_id", "left")
    for c in configs:
        for opened, mark in ((True, ""), (False, "_noacc")):
            on = on.withColumn(f"__add{mark}{c.suffix}", weight(c, F.col("E_min"), rt, opened))
    joined = sums.join(on.select("sirna_id", *(F.col(f"`__add{m}{c.suffix}`") for c in configs for m in ("", "_noacc"))), "sirna_id", "left")
    columns = [F.col("sirna_id"), F.col("E_min")]
    for c in configs:
        for mark in ("", "_noacc"):
            add = F.coalesce(F.col(f"`__add{mark}{c.suffix}`"), F.lit(0.0))
            columns += [(_z(f"{mark}{c.suffix}") + add).alias(f"Z_sirna{mark}{c.suffix}"), add.alias(f"W_on{mark}{c.suffix}")]
    return joined.select(*columns)


def summary(sums: DataFrame, configs: list[Config]) -> DataFrame:
    """A row for each siRNA and config: P, Z and Zoff, with and without opening energy."""
    entries = []
    for n, c in enumerate(configs):
        fields = [F.lit(n).alias("config_number"), F.lit(c.title).alias("config")]
        for mark in ("", "_noacc"):
            z, w = _z(f"{mark}{c.suffix}"), F.col(f"`W_on{mark}{c.suffix}`")
            fields += [F.when(z > 0, w / z).otherwise(F.lit(0.0)).alias(f"P{mark}"), z.alias(f"Z{mark}"), (z - w).alias(f"Zoff{mark}")]
        entries.append(F.struct(*fields))
    return sums.select("sirna_id", F.explode(F.array(*entries)).alias("s")).select("sirna_id", "s.*")


def score_together(sites: DataFrame, temperature: float = DEFAULT_TEMPERATURE, on_target: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """One partition function over all sites: (sites with probabilities, one row of totals).

    Missing expression counts as zero. ``on_target`` (energy, opening_energy, expression,
    chrom, start, end, strand) adds its weight to Z and a row named onTarget to the sites.
    """
    rt = thermal_energy(temperature)
    rows = prepare(sites).withColumn("exp_value", F.coalesce(F.col("exp_value").cast("double"), F.lit(0.0)))
    rows = rows.withColumn("boltzmann_weight", weight(Config(), F.lit(None), rt))
    add = F.lit(0.0)
    if on_target:
        total = on_target["energy"] + on_target.get("opening_energy", 0.0)
        add = F.lit(float(on_target.get("expression", 1000.0))) * F.exp(F.lit(-total / rt))
    totals = rows.agg(F.coalesce(F.sum("boltzmann_weight"), F.lit(0.0)).alias("z_off_target")).withColumn("w_on_target", add)
    totals = totals.withColumn("z_total", F.col("z_off_target") + F.col("w_on_target"))
    z = F.col("z_total")
    # The one row of totals is joined by a constant key, so the plan has no product of tables.
    scored = rows.withColumn("__one", F.lit(1)).join(F.broadcast(totals.select("z_total", F.lit(1).alias("__one"))), "__one")
    scored = scored.withColumn("P_off_target", F.when(z > 0, F.col("boltzmann_weight") / z).otherwise(F.lit(0.0))).drop("__one", "z_total")
    if on_target:
        own = totals.select(
            *(F.lit(on_target.get(c)).alias(c) for c in ("chrom", "start", "end", "strand")),
            F.lit(float(on_target["energy"])).alias("energy"),
            F.lit(float(on_target.get("opening_energy", 0.0))).alias("opening_energy"),
            F.lit(float(on_target.get("expression", 1000.0))).alias("exp_value"),
            F.lit("onTarget").alias("transcript_id"),
            F.lit("onTarget").alias("gene_id"),
            F.lit(float(on_target["energy"]) + float(on_target.get("opening_energy", 0.0))).alias("dG_total"),
            F.when(z > 0, F.col("w_on_target") / z).otherwise(F.lit(0.0)).alias("P_off_target"),
        )
        kinds = dict(scored.dtypes)
        own = own.select(*(F.col(c).cast(kinds[c]).alias(c) for c in own.columns if c in kinds))
        scored = scored.unionByName(own, allowMissingColumns=True)
    return scored, totals


def transcript_probabilities(
    sites: DataFrame, configs: list[Config], on_energy: float = 0.0, on_opening: float = 0.0, expression: float = 1000.0, temperature: float = DEFAULT_TEMPERATURE
) -> tuple[DataFrame, DataFrame]:
    """By (chrom, transcript_id) and config: the transcript's probability; and one row of totals.

    The clamp is at the least energy of all sites and the on-target. All configs are sums
    of one aggregation, so no two results need joining.
    """
    rt = thermal_energy(temperature)
    rows = prepare(sites).drop("E_min")
    least = rows.agg(F.least(F.min("energy").cast("double"), F.lit(on_energy)).alias("E_min")).withColumn("__one", F.lit(1))
    rows = rows.withColumn("__one", F.lit(1)).join(F.broadcast(least), "__one")
    own = least.withColumn("energy", F.lit(on_energy)).withColumn("opening_energy", F.lit(on_opening)).withColumn("exp_value", F.lit(expression))
    modes = [(c, m) for c in configs for m in ("", "_noacc")]
    w = lambda c, m: weight(c, F.col("E_min"), rt, m == "")
    by = rows.groupBy("chrom", "transcript_id").agg(*(F.sum(w(c, m)).alias(f"W{m}{c.suffix}") for c, m in modes))
    off = by.agg(*(F.coalesce(F.sum(F.col(f"`W{m}{c.suffix}`")), F.lit(0.0)).alias(f"Zoff{m}{c.suffix}") for c, m in modes)).withColumn("__one", F.lit(1))
    on = own.select("__one", *(w(c, m).alias(f"W_on{m}{c.suffix}") for c, m in modes))
    totals = off.join(F.broadcast(on), "__one")
    joined = by.withColumn("__one", F.lit(1)).join(F.broadcast(totals), "__one")
    probability = lambda c, m: F.col(f"`W{m}{c.suffix}`") / (F.col(f"`Zoff{m}{c.suffix}`") + F.col(f"`W_on{m}{c.suffix}`"))
    z = lambda c, m: F.col(f"`Zoff{m}{c.suffix}`") + F.col(f"`W_on{m}{c.suffix}`")
    out = joined.select(
        "chrom", "transcript_id", *(F.when(z(c, m) > 0, probability(c, m)).otherwise(F.lit(0.0)).alias(f"P{m}{c.suffix}") for c, m in modes)
    )
    return out, totals.drop("__one")


def top_sites(scored: DataFrame, n: int = 10) -> DataFrame:
    """The n most probable sites; ties by siRNA and place. Each task sends n rows."""
    order = [F.desc_nulls_first("P_off_target"), "sirna_id", "chrom", "start", "end", "strand", "transcript_id"]
    return scored.orderBy(*order).limit(n)


def best_hits(sites: DataFrame) -> DataFrame:
    """Each siRNA's site of least energy; ties to the first place."""
    best = F.min(F.struct("energy", "chrom", "start", "end", "strand")).alias("b")
    return sites.groupBy("sirna_id").agg(best).select("sirna_id", "b.energy", "b.chrom", "b.start", "b.end", "b.strand")
