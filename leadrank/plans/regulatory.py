"""The regulatory profile end to end: raw files to ranked leads, gate, exports, history.

Stages that several consumers read are Parquet tables below `work`; everything
between them is lazy. Nothing is collected but the run date, the fourteen-row
check table, and the manifests' sums and the kept runs' dates.
"""
from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import rules
from ..operators import features, history, link, lists, match, nested, quality, rank, score, staging
from ..sources import archives, incremental, sinks, text_files
from ..sources.store import Store

RAW_COLUMNS = {
    "inspection": ["activity_nr", "estab_name", "site_address", "site_city", "site_state", "site_zip", "naics_code",
                   "nr_in_estab", "owner_type", "insp_type", "open_date", "close_case_date"],
    "violation": ["activity_nr", "citation_id", "standard", "viol_type", "issuance_date", "current_penalty",
                  "initial_penalty", "contest_date", "final_order_date", "delete_flag"],
    "emphasis_codes": ["activity_nr", "prog_value"],
    "accident_injury": ["summary_nr", "rel_insp_nr", "degree_of_inj"],
    "accident": ["summary_nr", "event_date"],
}


@dataclass
class Build:
    """One run over `raw` files (one folder of archives per table), with stage tables in `work` and results in `out`."""

    spark: SparkSession
    raw: str
    work: str
    out: str
    states: tuple = rules.TERRITORY
    load_start: str = rules.LOAD_START
    emission_files: list = field(default_factory=list)

    def _saved(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.work}/{name}")

    def _save(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.work}/{name}")
        return self._saved(name)

    @property
    def loaded(self) -> Store:
        """Parsed rows of all archives, with the manifest of what they were parsed from."""
        return Store(self.spark, f"{self.work}/loaded")

    @property
    def runs(self) -> Store:
        """History (Hot leads of the latest runs) and score snapshots (one part a run)."""
        return Store(self.spark, f"{self.out}/runs")

    def load(self) -> None:
        """Archives to scoped raw tables. Members that have not changed since the last load are not parsed again.

        `load_counts` gets the rows kept, the rows of all states and the rejected lines of each table; rejected lines
        go to `rejects` with their archive and member.
        """
        parsed = {name: incremental.load(self.spark, self._archives(name), columns, self.loaded, name)
                  for name, columns in RAW_COLUMNS.items()}
        raw = {name: rows.filter(F.col(archives.REJECT).isNull()).select(*RAW_COLUMNS[name]) for name, rows in parsed.items()}
        inspection = self._save("raw_inspection", staging.scope_filter(raw["inspection"], self.states, self.load_start))
        injury = self._save("raw_accident_injury", staging.children_of(
            raw["accident_injury"], inspection, "rel_insp_nr", "activity_nr"))
        for name in ("violation", "emphasis_codes"):
            self._save(f"raw_{name}", staging.children_of(raw[name], inspection, "activity_nr"))
        self._save("raw_accident", staging.children_of(raw["accident"], injury, "summary_nr"))
        places = incremental.load(self.spark, f"{self.raw}/zip_gazetteer.zip", text_files.GAZETTEER, self.loaded, "places",
                                  delimiter="\t", own_header=False)
        self._save("zip_centroids", text_files.centroids(places.filter(F.col(archives.REJECT).isNull())))
        whole = self.spark.createDataFrame([(f"raw_{name}", *incremental.counts(self.loaded, name)) for name in RAW_COLUMNS],
                                           "name string, national long, rejected long")
        kept = text_files.load_counts({f"raw_{name}": self._saved(f"raw_{name}") for name in RAW_COLUMNS})
        self._save("load_counts", kept.join(whole, "name"))
        rejects = reduce(DataFrame.unionByName, [rows.filter(F.col(archives.REJECT).isNotNull()).select(
            F.lit(name).alias("name"), F.col(archives.ARCHIVE).alias("archive"), F.col(archives.MEMBER).alias("member"),
            F.col(archives.REJECT).alias("text")) for name, rows in parsed.items()])
        self._save("rejects", rejects)

    def _archives(self, name: str) -> str:
        return f"{self.raw}/{name}/*.zip"

    def tables(self) -> dict[str, DataFrame]:
        """Staged, linked and scored tables."""
        raw = {name: self._saved(f"raw_{name}") for name in RAW_COLUMNS}
        t: dict[str, DataFrame] = {}
        t["inspections"] = self._save("inspections", staging.inspections(raw["inspection"]))
        t["violations"] = self._save("violations", staging.violations(raw["violation"], t["inspections"]))
        programs = staging.dust_programs(raw["emphasis_codes"], t["inspections"])
        injuries = staging.injuries(raw["accident_injury"], raw["accident"], t["inspections"])
        t["withdrawn"] = raw["violation"].filter(F.col("delete_flag") == "X").select(
            F.col("activity_nr").cast("long").alias("activity_nr"), "citation_id", "standard")
        t["standard_lookup"] = self._save("standard_lookup", features.standard_lookup(t["violations"]))
        resolved = link.resolve(t["inspections"].select(
            F.col("activity_nr").cast("string").alias("record_id"), F.col("estab_name").alias("name"),
            F.col("site_address").alias("address"), F.col("zip5").alias("zip"), F.col("site_state").alias("state")))
        t["facility_map"] = self._save("facility_map", resolved.select(
            F.col("record_id").cast("long").alias("activity_nr"), "facility_id", "review_required"))
        t["run_params"] = self._save("run_params", features.run_params(t["inspections"], t["violations"]))
        fi = self._save("facility_inspections", features.facility_inspections(
            t["inspections"], t["facility_map"], programs))
        t["evidence"] = self._save("evidence", features.evidence(
            t["violations"], fi, t["standard_lookup"], t["run_params"]))
        t["facilities"] = self._save("facilities", features.facility_facts(
            fi, t["violations"], injuries, t["standard_lookup"], t["run_params"]))
        text_files.require_files(self.emission_files, self.states)
        forms = text_files.require_contract(
            text_files.read_emission_files(self.spark, self.emission_files, self.states))
        matched = self._save("matched", match.matched_keys(forms, t["facilities"]))
        t["signals"], t["match_stats"] = match.air_signals(matched), match.match_stats(matched)
        t["scores"] = self._save("scores", score.score(t["facilities"], t["signals"], t["run_params"]))
        return t

    def run(self, skip_load: bool = False) -> dict[str, DataFrame]:
        """Whole run. Outputs are written only if every check passes."""
        if not skip_load:
            self.load()
        t = self.tables()
        checks = self._save("checks", quality.run_checks(t, self.states, self.load_start))
        quality.require_passed(checks)
        as_of = F.lit(t["run_params"].first().as_of)
        ranked = self._save("ranked", rank.global_rank(
            lists.assemble(t["scores"], self._saved("zip_centroids")), rank.lead_order()))
        shown = nested.shown_leads(ranked)
        sinks.write_ranked_csv(ranked, f"{self.out}/leads_csv")
        evidence = self._save("shown_evidence", nested.shown_evidence(t["evidence"], shown))
        sinks.write_lead_json(nested.lead_records(shown, evidence), f"{self.out}/leads_json")
        t["new_hot"] = self._delta(ranked, as_of)
        self._report(t, ranked, checks, as_of)
        t["ranked"], t["checks"] = ranked, checks
        return t

    def _report(self, t: dict[str, DataFrame], ranked: DataFrame, checks: DataFrame, as_of: Column) -> None:
        """Summary, best leads, breakdowns, checks and new Hot leads as CSV; the run log gets the run's record."""
        counts = features.attach(lists.tier_counts(ranked), t["match_stats"])
        tables = {
            "summary": counts,
            "top25": lists.csv_columns(lists.brief_candidates(ranked)),
            "by_state": lists.hot_by(ranked, lists.state_dimension(self.spark, self.states), "state"),
            "by_industry": lists.hot_by(ranked, lists.industry_dimension(self.spark), "industry"),
            "checks": checks,
            "new_hot_leads": history.new_hot_list(t["new_hot"], ranked),
        }
        for name, table in tables.items():
            sinks.write_safe_csv(table, f"{self.out}/report/{name}")
        sinks.write_run_log(history.run_record(counts, self._saved("load_counts"), checks, rules.EMISSION_YEAR)
                            .withColumn("as_of", as_of), f"{self.out}/run_log")

    def _delta(self, ranked: DataFrame, as_of: Column) -> DataFrame:
        """New Hot leads against the history; the run then joins history and snapshots, in one commit."""
        hot = ranked.filter(F.col("tier") == rules.HOT).select("facility_id")
        past = self.runs.read("history")
        if past is None:
            past = self.spark.createDataFrame([], "as_of date, facility_id string, run_seq long")
        fresh = self._save("new_hot", history.new_hot(hot, past, as_of))
        # a run without Hot leads is a run as well: a row without an id stands for it
        entry = (hot.unionByName(self.spark.range(1).select(F.lit(None).cast("string").alias("facility_id")))
                 .select(as_of.alias("as_of"), "facility_id"))
        kept = self.runs.write("history", history.upsert_run(past, entry))
        snapshot = self.runs.write("snapshots", history.snapshot_score_run(ranked, as_of, F.current_timestamp()))
        days = [str(r.as_of) for r in self.spark.read.parquet(f"{self.runs.path}/{kept}").select("as_of").distinct().collect()]
        today = str(self.spark.range(1).select(as_of).first()[0])
        shots = {**self.runs.parts("snapshots"), today: snapshot}  # one part a run, of the runs that history keeps
        self.runs.commit(history={"": kept}, snapshots={day: folder for day, folder in shots.items() if day in days})
        return fresh
