"""The jobs as registered queries: each runs twice into a new folder, and what then stands there is the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duplexa.functions.parameters import sweep
from duplexa.functions.sequences import BASES, LETTERS
from duplexa.plans.workload import TARGETS, VIEWS, factor, oligo_sql
from duplexa.sources.files import new_folder
from jobs import gene_risk, seed_screen


def job1_gene_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = new_folder(spark, "gene_risk")
    gene_risk.run(spark, sf_dir, output)
    return gene_risk.run(spark, sf_dir, output)


def job2_seed_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "seed_screen")
    seed_screen.run(spark, sf_dir, f"{folder}/hits", f"{folder}/checkpoint")
    return seed_screen.run(spark, sf_dir, f"{folder}/hits", f"{folder}/checkpoint")


QUERIES = {f.__name__: f for f in (job1_gene_risk, job2_seed_screen)}


def _gene_risk_sql() -> str:
    """The settings file's sweep written out."""
    configs = sweep("0.8;1.0", "0.9;1.0", "0.85")
    energy = {
        c: f"CAST({c.theta} AS DOUBLE) * (energy + 10) - 10" if c.theta is not None
        else f"CASE WHEN energy < CAST({c.alpha} AS DOUBLE) * e_min THEN CAST({c.gamma} AS DOUBLE) * e_min ELSE energy END" if c.suffix
        else "energy"
        for c in configs
    }
    weights = ", ".join(f"exp_value * {factor(energy[c])} AS w{n}" for n, c in enumerate(configs))
    chances = ", ".join(f"w{n} / sum(w{n}) OVER (PARTITION BY sirna_id) AS p{n}" for n in range(len(configs)))
    sums = ", ".join(f"round(sum(p{n}), {gene_risk.PLACES}) AS {gene_risk.column(c)}" for n, c in enumerate(configs))
    return f"""
        WITH {VIEWS}, {TARGETS},
        m AS (
            SELECT single.*, min(energy) OVER (PARTITION BY sirna_id) AS e_min, coalesce(transcript_id = target_id OR gene_id = target_id, false) AS is_on_target
            FROM single LEFT JOIN target USING (sirna_id)
        ), w AS (SELECT *, {weights} FROM m), p AS (SELECT *, {chances} FROM w),
        g AS (
            SELECT chrom, sirna_id, gene_id, CAST(count(*) AS BIGINT) AS n_sites, CAST(count(DISTINCT transcript_id) AS BIGINT) AS n_transcripts,
                min(energy) AS least_energy, bool_or(is_on_target) AS is_on_target, {sums}
            FROM p GROUP BY chrom, sirna_id, gene_id
        )
        SELECT *, CAST(row_number() OVER (PARTITION BY sirna_id ORDER BY least_energy, chrom, gene_id) AS INTEGER) AS energy_rank FROM g
    """


ORACLE_SQL = {
    "job1_gene_risk": _gene_risk_sql(),
    "job2_seed_screen": f"""
        WITH q AS (SELECT CAST(p_partkey AS VARCHAR) AS sirna_id, reverse(translate(substring({oligo_sql("p_partkey", 24)}, 2, 7), 'ACGU', 'UGCA')) AS kmer FROM part),
        s AS (SELECT doc_id, lang, translate(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g'), '{LETTERS}', '{BASES}') AS bases FROM documents),
        t AS (SELECT doc_id, lang, bases, unnest(range(1, greatest(length(bases) - 6, 0) + 1)) AS place FROM s)
        SELECT sirna_id, doc_id, lang, CAST(count(*) AS BIGINT) AS n_sites, CAST(min(place) AS INTEGER) AS first_site
        FROM t JOIN q ON q.kmer = substring(bases, place, 7) GROUP BY sirna_id, doc_id, lang
    """,
}
