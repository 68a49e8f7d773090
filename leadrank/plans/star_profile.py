"""Profile of the star-schema test tables: which column plays which role.

Each role is a list of SELECT expressions over whole tables, kept in the SQL that
Spark and the checking engine share, so both sides start from the same input
rows. Everything after these selects is computed apart.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import rules
from ..operators import features, match, nested, score, staging
from ..operators.features import param
from ..session import stage_table

S = "CAST({} AS STRING)".format
DAY = "CAST({} AS DATE)".format
PLUS = "CAST(CAST({0} AS DATE) + INTERVAL '{1}' DAY AS DATE)".format
STATE = f"concat('S', lpad({S('c_nationkey')}, 2, '0'))"

# record <- orders with their customer
INSPECTION = [
    "o_orderkey AS activity_nr",
    f"concat('f', {S('o_custkey')}) AS facility_id",
    f"concat(c_mktsegment, ' WORKS ', {S('c_custkey')}, "
    "CASE WHEN o_orderstatus = 'P' THEN ' INC' ELSE ' LLC' END) AS estab_name",
    f"concat({S('c_nationkey + 1')}, ' MAIN STREET') AS site_address",
    f"concat('PORT O''NATION ', {S('c_nationkey')}) AS site_city",
    f"{STATE} AS site_state",
    f"CASE WHEN o_totalprice >= 3000 THEN {S('10000 + c_custkey % 90000')} END AS zip5",
    "CASE WHEN o_totalprice >= 495000 THEN '311811' WHEN c_mktsegment = 'FURNITURE' THEN '337110' "
    "WHEN c_mktsegment = 'BUILDING' THEN '321918' WHEN c_mktsegment = 'MACHINERY' THEN '333120' "
    "WHEN c_mktsegment = 'HOUSEHOLD' THEN '325412' ELSE '336310' END AS naics_code",
    "CASE WHEN c_acctbal < 0 THEN NULL WHEN o_totalprice >= 480000 THEN CAST(floor(o_totalprice / 20) AS INT) "
    "ELSE CAST(floor(o_totalprice / 400) AS INT) END AS employees_reported",
    "CASE WHEN o_orderstatus = 'F' AND o_totalprice >= 490000 THEN 'M' "
    "WHEN o_orderstatus = 'P' AND o_totalprice >= 490000 THEN 'A' ELSE 'H' END AS insp_type",
    f"{DAY('o_orderdate')} AS open_date",
    f"CASE WHEN o_orderstatus <> 'O' THEN {PLUS('o_orderdate', 90)} END AS close_case_date",
    "o_totalprice < 2500 AS review_required",
]

# citation code text, in the shapes the parser knows
_PARA = (f"concat(' ', substr('ABCDEFG', l_linenumber, 1), lpad({S('CAST(l_quantity AS INT) % 20')}, 2, '0'), "
         "CASE WHEN l_linenumber % 3 = 0 THEN ' I A' WHEN l_linenumber % 3 = 1 THEN ' IV' ELSE '' END)")
_FOUR = "lpad({}, 4, '0')".format
CODE = f"""CASE l_partkey % 10
 WHEN 0 THEN concat('1910', {_FOUR(S("CASE l_partkey % 40 WHEN 0 THEN 1053 WHEN 10 THEN 134 WHEN 20 THEN 252 ELSE 1200 END"))}, {_PARA})
 WHEN 5 THEN concat(CASE l_linenumber % 4 WHEN 0 THEN '1904' WHEN 1 THEN '1903' WHEN 2 THEN '1926' ELSE '1915' END, '0029 B03 IV')
 WHEN 6 THEN CASE WHEN l_linenumber = 7 THEN '408.1011' WHEN l_linenumber = 6 THEN ' 5a0001 ' ELSE '5A0001' END
 WHEN 7 THEN concat('325.', {S('50000 + (l_partkey * 13 + CAST(l_quantity AS INT) * 17) % 12000')}, '(', {S('l_linenumber')}, ')')
 WHEN 8 THEN concat('408.', CASE WHEN l_linenumber = 6 THEN {S('22000 + l_partkey % 250')}
   ELSE {S('10000 + (l_partkey * 11 + l_linenumber) % 10000')} END, CASE WHEN l_linenumber = 3 THEN 'a (1)' ELSE '' END)
 WHEN 9 THEN CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' ELSE concat('T8 CCR ', {S('l_partkey % 50')}) END
 ELSE concat('1910', {_FOUR(S("(l_partkey * 7 + l_linenumber * 31) % 1300"))}, {_PARA}) END"""
WITHDRAWN = "l_discount >= 0.0999"

# citation <- lineitem
VIOLATION = [
    "l_orderkey AS activity_nr",
    f"lpad({S('l_linenumber')}, 5, '0') AS citation_id",
    f"trim({CODE}) AS standard",
    "CASE WHEN l_returnflag = 'R' THEN 'S' WHEN l_returnflag = 'A' THEN 'O' "
    "WHEN l_tax >= 0.06 THEN 'W' WHEN l_tax >= 0.03 THEN 'R' ELSE 'X' END AS viol_type",
    f"{DAY('l_shipdate')} AS issuance_date",
    "CASE WHEN l_tax >= 0.02 THEN l_extendedprice END AS current_penalty",
    "CASE WHEN l_quantity >= 3 THEN l_extendedprice * 2 END AS initial_penalty",
    f"CASE WHEN l_returnflag = 'R' AND l_quantity >= 50 THEN {PLUS('l_shipdate', 20)} END AS contest_date",
    f"CASE WHEN l_linestatus = 'F' THEN {PLUS('l_shipdate', 60)} END AS final_order_date",
]

# injury <- lineitem with a large quantity
INJURY_ROWS = "l_quantity >= 48"
INJURY = [
    "l_orderkey AS activity_nr",
    f"CASE WHEN l_linenumber < 7 THEN {DAY('l_shipdate')} END AS event_date",
    "CASE WHEN l_quantity = 49 AND l_tax >= 0.0799 THEN 'fatality' "
    "WHEN l_quantity = 48 AND l_tax >= 0.0699 THEN 'hospitalized' ELSE 'other' END AS degree",
]

# emphasis programs <- orders
NEP_ROWS = "o_orderpriority = '1-URGENT' AND o_totalprice < 60000"
SILICA_ROWS = "o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice < 30000"

# emission form <- events of a customer
FORM_FACILITY = f"concat(lower(c_mktsegment), ' Works ', {S('c_custkey')}, ', Inc.')"
FORM = [
    "'2024' AS year", f"{FORM_FACILITY} AS facility_name", f"{STATE} AS state",
    f"concat({S('10000 + c_custkey % 90000')}, '-0001') AS zip",
    "concat(upper(event_type), '  COMPOUNDS (TOTAL)') AS chemical",
    "CASE WHEN event_type IN ('error', 'purchase') THEN ' yes' ELSE 'NO' END AS metal",
    "CASE WHEN event_id % 5 = 4 THEN 'A' ELSE 'R' END AS form_type",
    "CASE WHEN event_id % 7 = 6 THEN 'Grams' ELSE 'Pounds' END AS unit",
    f"CASE WHEN value < 2 THEN 'N/A' ELSE concat('1,', lpad({S('CAST(floor(value) AS INT) % 1000')}, 3, '0'), '.5') "
    "END AS fugitive_air",
    "CASE WHEN event_id % 3 = 0 THEN ' na ' ELSE '0' END AS stack_air",
    "CASE c_mktsegment WHEN 'FURNITURE' THEN '337110' WHEN 'BUILDING' THEN '321918' "
    "WHEN 'MACHINERY' THEN '333120' ELSE '999999' END AS naics_1",
    "CAST(NULL AS STRING) AS naics_2", "CAST(NULL AS STRING) AS naics_3", "CAST(NULL AS STRING) AS naics_4",
    "CAST(NULL AS STRING) AS naics_5",
    "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ' 325412' END AS naics_6",
]

# linkage record <- part
LINK_RECORD = [
    f"{S('p_partkey')} AS record_id",
    f"concat(CASE WHEN p_partkey % 11 = 0 THEN concat({S('100000 + p_partkey')}, ' - ') ELSE '' END, p_name, ' ', p_type, "
    "CASE p_partkey % 4 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' L.L.C.' WHEN 2 THEN ' & Co dba OTHER NAME' ELSE ' **' END) AS name",
    f"concat({S('p_size % 10')}, ' North Main Street', CASE WHEN p_partkey % 3 = 0 THEN ' Suite 9' ELSE '' END) AS address",
    "CASE WHEN p_partkey % 50 > 0 THEN concat(lpad(substr(p_brand, 7), 5, '4'), '-', "
    f"{S('1000 + p_size')}) END AS zip",
    f"concat(' s', {S('p_partkey % 3')}) AS state",
]

# coordinates <- customer
CENTROID = [
    f"{S('10000 + c_custkey % 90000')} AS zip5",
    "CASE WHEN c_acctbal >= -500 THEN 25 + (c_custkey % 2400) / 100.0E0 END AS lat",
    "-124 + (c_custkey * 7 % 5600) / 100.0E0 AS lon",
]
SIGN_OFF = "The Field Team"


class StarTables:
    """Canonical tables over one data folder, built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        return self._once(f"read {name}", lambda: self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def _once(self, name: str, make) -> DataFrame:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def stage(self, *names: str) -> None:
        """Turn tables into stage tables, for queries that read them many times over."""
        for name in names:
            made = getattr(self, name)
            self._made[name] = stage_table(made, name)

    @property
    def inspections(self) -> DataFrame:
        def make():
            rows = self.read("orders").join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
            return rows.selectExpr(*INSPECTION).withColumn(
                "employees", staging.plausible_headcount(F.col("employees_reported")))
        return self._once("inspections", make)

    @property
    def facility_map(self) -> DataFrame:
        return self.inspections.select("activity_nr", "facility_id", "review_required")

    @property
    def violations(self) -> DataFrame:
        return self._once("violations", lambda: self.read("lineitem").filter(f"NOT ({WITHDRAWN})")
                          .selectExpr(*VIOLATION))

    @property
    def withdrawn(self) -> DataFrame:
        return self.read("lineitem").filter(WITHDRAWN).selectExpr(*VIOLATION[:3])

    @property
    def injuries(self) -> DataFrame:
        return self.read("lineitem").filter(INJURY_ROWS).selectExpr(*INJURY)

    @property
    def dust_programs(self) -> DataFrame:
        """Both conditions read the same row, so one scan yields up to two programs; repeated rows stay, as in the source."""
        found = F.array_compact(F.array(
            F.when(F.expr(NEP_ROWS), F.lit(rules.DUST_PROGRAM)),
            F.when(F.expr(SILICA_ROWS), F.lit(rules.SILICA_PROGRAM))))
        return self.read("orders").select(F.col("o_orderkey").alias("activity_nr"),
                                          F.explode(found).alias("program"))

    @property
    def facility_inspections(self) -> DataFrame:
        return self._once("fi", lambda: features.facility_inspections(
            self.inspections, None, self.dust_programs))

    @property
    def run_params(self) -> DataFrame:
        """Reads two date columns, nothing else."""
        def make():
            orders = self.read("orders").select(F.col("o_orderdate").cast("date").alias("open_date"))
            lines = (self.read("lineitem").filter(f"NOT ({WITHDRAWN})")
                     .select(F.col("l_shipdate").cast("date").alias("issuance_date")))
            return features.run_params(orders, lines)
        return self._once("run params", make)

    @property
    def params(self) -> DataFrame:
        """The one parameter row as a stage table: many predicates read it, the sources are scanned once."""
        return self._once("params", lambda: stage_table(self.run_params, "params"))

    @property
    def as_of(self):
        return param(self.params, "as_of")

    @property
    def codes(self) -> DataFrame:
        return features.standard_lookup(self.violations)

    @property
    def lookup(self) -> DataFrame:
        """Parsed codes as a stage table: each code is parsed once per query."""
        return self._once("lookup", lambda: stage_table(self.codes, "codes"))

    @property
    def evidence(self) -> DataFrame:
        return self._once("evidence", lambda: features.evidence(
            self.violations, self.facility_inspections, self.lookup, self.params))

    @property
    def facilities(self) -> DataFrame:
        return features.facilities(self.facility_inspections, self.params)

    @property
    def facts(self) -> DataFrame:
        """Entity-level facts as a stage table: matching and scoring both read it."""
        return self._once("facts", lambda: stage_table(features.facility_facts(
            self.facility_inspections, self.violations, self.injuries, self.lookup, self.params), "facts"))

    @property
    def forms(self) -> DataFrame:
        rows = self.read("events").join(self.read("customer"), F.col("user_id") == F.col("c_custkey"))
        return rows.selectExpr(*FORM)

    @property
    def matched(self) -> DataFrame:
        """Form matches against the latest name, state and ZIP of each entity."""
        return self._once("matched", lambda: match.matched_keys(self.forms, self.facts))

    @property
    def signals(self) -> DataFrame:
        return match.air_signals(self.matched)

    @property
    def scores(self) -> DataFrame:
        return self._once("scores", lambda: score.score(self.facts, self.signals, self.params))

    @property
    def centroids(self) -> DataFrame:
        return self.read("customer").selectExpr(*CENTROID)

    @property
    def territory(self) -> DataFrame:
        """States in report order, from the nation table."""
        return self.read("nation").select(
            (F.col("n_nationkey") + 1).alias("position"),
            F.concat(F.lit("S"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("state"))

    @property
    def shown(self) -> DataFrame:
        return nested.shown_leads(self.scores)

    @property
    def staged_shown(self) -> DataFrame:
        """Shown leads as a stage table, for queries that use them several times."""
        return self._once("staged shown", lambda: stage_table(self.shown, "shown"))

    @property
    def shown_evidence(self) -> DataFrame:
        """Evidence of the shown leads, as a stage table."""
        return self._once("shown evidence", lambda: stage_table(self.evidence_of(self.staged_shown), "evidence"))

    def evidence_of(self, leads: DataFrame) -> DataFrame:
        """Evidence of some leads, from their records."""
        return features.evidence(self.violations, self.records_of(leads), self.lookup, self.params)

    def records_of(self, leads: DataFrame) -> DataFrame:
        """Records of some leads as a stage table, picked in four columns before citations meet them, so that codes and
        titles are neither made for other leads nor shuffled once more by lead."""
        records = self.facility_inspections.select("facility_id", "activity_nr", "dust_program", "open_date")
        return stage_table(nested.shown_evidence(records, leads), "records")

    def citations_of(self, records: DataFrame) -> DataFrame:
        """What leads show of the citations of their records."""
        return nested.kept_citations(features.citation_evidence(
            features.telling_citations(self.violations, self.lookup), records, self.lookup, self.params))

    def inspections_of(self, records: DataFrame) -> DataFrame:
        """What leads show of their records, citations counted."""
        return nested.counted_inspections(
            records, features.citation_counts(self.violations, self.lookup, self.params), param(self.params, "window_start"))

    @property
    def shown_records(self) -> DataFrame:
        return self._once("shown records", lambda: self.records_of(self.staged_shown))

    @property
    def citations(self) -> DataFrame:
        return self._once("citations", lambda: stage_table(self.citations_of(self.shown_records), "citations"))

    @property
    def shown_inspections(self) -> DataFrame:
        return self._once("shown inspections", lambda: stage_table(self.inspections_of(self.shown_records), "kept"))
