"""Adapters from the driver's TPC-H-like tables to the reference's schemas.

The reference's own inputs are four tiny CSVs; to exercise every operator at
sf0.001 .. sf0.1 (and at cluster scale) the same shapes are derived from
``region nation supplier customer part orders lineitem``:

* regions      <- region
* providers    <- supplier + nation       (provider per supplier)
* patients     <- customer + nation       (attributes from the key)
* claim events <- lineitem + orders + part + supplier + nation (one claim per line)
* prescription events <- the same lines (quantity = l_quantity)
* visit events <- orders + per-order line summary (admission = order date,
  discharge = last ship date; orders without lines keep a null discharge)
* claim / prescription aggregates <- lineitem grouped by provider region,
  category, month (and status), i.e. the reference's monthly aggregate input;
  their providers come from ``region`` (one provider per region).

Join order is written small-first (nation -> supplier -> lines) because
Catalyst does not reorder joins without CBO statistics; nation and region
are broadcast explicitly (TPC-H fixes them at 25 and 5 rows). Orders and
parts are broadcast under the size threshold by their row counts, and hashed
in each shuffle partition far beyond it (``keys.hashed_lookup``), so lines are
not sorted to meet them; suppliers are left to the planner and AQE (skew
splitting on).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.functions import hashing as H
from claimsmith.operators.keys import hashed_lookup

# Fixed values of the adapter (shared with the oracle SQL in plans/oracle.py).
PROVIDER_TYPES = ("hospital", "clinic", "pharmacy", "general_practitioner")
STATUS_BY_RETURNFLAG = {"A": "approved", "N": "pending", "R": "rejected"}
HIGH_POPULATION_REGION_KEYS = (0, 1)
ID_PAD = 10


class Tables:
    """Lazy parquet readers for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._rows = spark, sf_dir.rstrip("/"), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def rows(self, name: str) -> int:
        """The rows of a table, counted (from the file footers) once."""
        if name not in self._rows:
            self._rows[name] = getattr(self, name).count()
        return self._rows[name]


def _pad_id(prefix: str, key: Column | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(prefix), F.lpad(k.cast("string"), ID_PAD, "0"))


def _region_id(key: Column | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("R"), k.cast("string"))


def _by_key(values: tuple[str, ...], key: Column) -> Column:
    m = F.pmod(key, F.lit(len(values)))
    out = F.lit(None).cast("string")
    for i, v in reversed(list(enumerate(values))):
        out = F.when(m == i, F.lit(v)).otherwise(out)
    return out


def _status(flag: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in STATUS_BY_RETURNFLAG.items():
        out = F.when(flag == k, F.lit(v)).otherwise(out)
    return out


def _nation(t: Tables) -> DataFrame:
    return F.broadcast(t.nation.select("n_nationkey", "n_regionkey"))


def regions(t: Tables) -> DataFrame:
    return t.region.select(
        _region_id("r_regionkey").alias("region_id"),
        F.col("r_name").alias("region_name"),
        F.when(F.col("r_regionkey").isin(*HIGH_POPULATION_REGION_KEYS), F.lit("high")).otherwise(
            F.lit("medium")).alias("population_group"),
    )


def providers(t: Tables) -> DataFrame:
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    j = s.join(_nation(t), s.s_nationkey == F.col("n_nationkey"), "left")
    return j.select(
        _pad_id("S", "s_suppkey").alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        _by_key(PROVIDER_TYPES, F.col("s_suppkey")).alias("provider_type"),
        _region_id("n_regionkey").alias("region_id"),
    )


def patients(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_nationkey")
    j = c.join(_nation(t), c.c_nationkey == F.col("n_nationkey"), "left")
    k = F.col("c_custkey")
    month, day = F.pmod(k, F.lit(12)) + 1, F.pmod(k, F.lit(28)) + 1
    return j.select(
        _pad_id("C", "c_custkey").alias("patient_id"),
        F.make_date((F.lit(H.BIRTH_YEAR_BASE) + F.pmod(k, F.lit(H.BIRTH_YEAR_SPAN))).cast("int"),
                    month.cast("int"), day.cast("int")).alias("birth_date"),
        F.when(F.pmod(k, F.lit(2)) == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        _region_id("n_regionkey").alias("region_id"),
        F.make_date((F.lit(H.REGISTRATION_YEAR_BASE) + F.pmod(k, F.lit(H.REGISTRATION_YEAR_SPAN))).cast("int"),
                    month.cast("int"), day.cast("int")).alias("registration_date"),
    )


def _price_cents_dec(price: str = "l_extendedprice") -> Column:
    return F.col(price).cast("decimal(12,2)")


def _reimbursed_dec() -> Column:
    """Billed x (1 - discount) in exact decimals, half-up to the cent."""
    return F.round(_price_cents_dec() * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 2)


def _supplier_region(t: Tables) -> DataFrame:
    s = t.supplier.select("s_suppkey", "s_nationkey")
    return s.join(_nation(t), s.s_nationkey == F.col("n_nationkey"), "left").select(
        "s_suppkey", "s_nationkey", "n_regionkey")


def _part_kinds(t: Tables) -> DataFrame:
    """Category and treatment id by part: one hash a part, not one a line."""
    category = F.lower(F.col("p_type"))
    kinds = t.part.select("p_partkey", category.alias("p_category"), H.category_id(category).alias("p_treatment_id"))
    return hashed_lookup(kinds, t.rows("part"))


def _lines(t: Tables, with_orders: bool) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                           "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    j = li.join(_supplier_region(t), li.l_suppkey == F.col("s_suppkey"), "left")
    if with_orders:  # before the part, whose texts would be shuffled with the lines
        orders = hashed_lookup(t.orders.select("o_orderkey", "o_custkey"), t.rows("orders"))
        j = j.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    j = j.join(_part_kinds(t), F.col("l_partkey") == F.col("p_partkey"), "left")
    return j.drop("s_suppkey", "o_orderkey", "p_partkey")  # the line's own keys tell them; written lines would hold both


def order_lines(t: Tables) -> DataFrame:
    """lineitem with supplier region, part type and order customer: the one
    join both event kinds project from (write it once when both are used)."""
    return _lines(t, with_orders=True)


def plain_lines(t: Tables) -> DataFrame:
    """The lines without their order: all that amounts, categories, providers
    and ship dates need."""
    return _lines(t, with_orders=False)


def _patient(lines: DataFrame) -> Column:
    """The order's customer; null for lines without their order."""
    return _pad_id("C", "o_custkey") if "o_custkey" in lines.columns else F.lit(None).cast("string")


def _claim_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


def _prescription_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                       F.col("l_partkey").cast("string"))


def claim_ids(t: Tables) -> DataFrame:
    """The ids of the claim events: a projection of lineitem, as the ids of the prescriptions."""
    return t.lineitem.select(_claim_id().alias("claim_id"))


def prescription_ids(t: Tables) -> DataFrame:
    return t.lineitem.select(_prescription_id().alias("prescription_id"))


def claim_events(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """One claim per lineitem row (duplicate line ids give duplicate claim
    ids). Given ``plain_lines``, claims have no patient."""
    j = order_lines(t) if lines is None else lines
    claim_id = _claim_id()
    return j.select(
        claim_id.alias("claim_id"),
        _patient(j).alias("patient_id"),
        _pad_id("S", "l_suppkey").alias("provider_id"),
        _region_id("n_regionkey").alias("region_id"),
        F.col("p_treatment_id").alias("treatment_id"),
        F.col("p_category").alias("treatment_category"),
        F.col("l_shipdate").cast("date").alias("claim_date"),
        _price_cents_dec().cast("double").alias("billed_amount"),
        _reimbursed_dec().cast("double").alias("reimbursed_amount"),
        _status(F.col("l_returnflag")).alias("claim_status"),
        claim_id.alias("source_row_key"),
    )


def claim_amounts(t: Tables) -> DataFrame:
    """Dates and amounts of the claim events: a projection of lineitem, for
    reports that need no attribute of a provider, patient or treatment."""
    return t.lineitem.select(
        F.col("l_shipdate").cast("date").alias("claim_date"),
        _price_cents_dec().cast("double").alias("billed_amount"),
        _reimbursed_dec().cast("double").alias("reimbursed_amount"))


def treatment_kinds(t: Tables) -> DataFrame:
    """The treatments of claim and prescription events of all lines: the
    distinct part keys first (combined map-side), so only they are joined."""
    keys = t.lineitem.select("l_partkey").distinct()
    return keys.join(_part_kinds(t), F.col("l_partkey") == F.col("p_partkey"), "left").select(
        F.col("p_treatment_id").alias("treatment_id"), F.col("p_category").alias("treatment_category")).distinct()


def nation_providers(t: Tables) -> DataFrame:
    """Providers of the coarse variant: one per nation."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    return n.select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("provider_id"),
        F.col("n_name").alias("provider_name"),
        _by_key(PROVIDER_TYPES, F.col("n_nationkey")).alias("provider_type"),
        _region_id("n_regionkey").alias("region_id"),
    )


def coarse_claim_events(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """Claim events at a coarse grain for the duplicate-pattern report: the
    provider is the supplier's nation and the date is the first day of the
    ship year, so (patient, provider, treatment, date) repeats often."""
    j = order_lines(t) if lines is None else lines
    claim_id = _claim_id()
    return j.select(
        claim_id.alias("claim_id"),
        _pad_id("C", "o_custkey").alias("patient_id"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("provider_id"),
        _region_id("n_regionkey").alias("region_id"),
        F.col("p_treatment_id").alias("treatment_id"),
        F.col("p_category").alias("treatment_category"),
        F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1)).alias("claim_date"),
        _price_cents_dec().cast("double").alias("billed_amount"),
        _reimbursed_dec().cast("double").alias("reimbursed_amount"),
        _status(F.col("l_returnflag")).alias("claim_status"),
        claim_id.alias("source_row_key"),
    )


def prescription_events(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    j = order_lines(t) if lines is None else lines
    rx_id = _prescription_id()
    return j.select(
        rx_id.alias("prescription_id"),
        _patient(j).alias("patient_id"),
        _pad_id("S", "l_suppkey").alias("provider_id"),
        _region_id("n_regionkey").alias("region_id"),
        F.col("p_treatment_id").alias("treatment_id"),
        F.col("p_category").alias("treatment_category"),
        F.col("l_shipdate").cast("date").alias("prescription_date"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        rx_id.alias("source_row_key"),
    )


def visit_events(t: Tables) -> DataFrame:
    """One visit per order; an order without lines keeps a null discharge and
    provider, and orders that end before they start give negative stays."""
    summary = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("v_suppkey"), F.max("l_shipdate").alias("v_last_ship"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    # The summary is there by order key already: orders meet it hashed, unsorted.
    j = o.join(summary.hint("shuffle_hash"), o.o_orderkey == summary.l_orderkey, "left")
    return j.select(
        F.concat(F.lit("V"), F.col("o_orderkey").cast("string")).alias("visit_id"),
        _pad_id("C", "o_custkey").alias("patient_id"),
        _pad_id("S", "v_suppkey").alias("provider_id"),
        F.lit(None).cast("string").alias("region_id"),
        F.lit(None).cast("string").alias("treatment_id"),
        F.col("o_orderdate").cast("date").alias("admission_date"),
        F.col("v_last_ship").cast("date").alias("discharge_date"),
        F.concat(F.lit("D"), F.lpad((F.pmod(F.col("o_orderkey"), F.lit(900)) + 100).cast("string"), 3, "0")).alias(
            "diagnosis_code"),
        F.lit(None).cast("string").alias("claim_id"),
    )


#: The reference's staging tables, derived directly from the test tables.
STAGING = {
    "stg_regions": regions,
    "stg_providers": providers,
    "stg_patients": patients,
    "stg_claims_events": claim_events,
    "stg_prescriptions_events": prescription_events,
    "stg_visits_events": visit_events,
}


def staging_tables(t: Tables) -> dict[str, DataFrame]:
    return {name: build(t) for name, build in STAGING.items()}


# --- monthly aggregates: the reference's raw claims / prescriptions input ---

def region_providers(t: Tables) -> DataFrame:
    """Providers of the aggregate flow: one per region."""
    return t.region.select(
        F.concat(F.lit("REG"), F.col("r_regionkey").cast("string")).alias("provider_id"),
        F.col("r_name").alias("provider_name"),
        _by_key(PROVIDER_TYPES, F.col("r_regionkey")).alias("provider_type"),
        _region_id("r_regionkey").alias("region_id"),
    )


def _agg_lines(t: Tables, yearly: bool) -> DataFrame:
    j = _lines(t, with_orders=False)
    month = (F.concat(F.year("l_shipdate").cast("string"), F.lit("-01")) if yearly
             else F.date_format("l_shipdate", "yyyy-MM"))
    return j.select(
        F.concat(F.lit("REG"), F.col("n_regionkey").cast("string")).alias("provider_id"),
        _region_id("n_regionkey").alias("region_id"),
        F.col("p_category").alias("treatment_category"),
        month.alias("claim_month"),
        _status(F.col("l_returnflag")).alias("claim_status"),
        _price_cents_dec().alias("billed_dec"),
        (_price_cents_dec() * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).alias("reimb_dec"),
        F.col("l_quantity").cast("bigint").alias("qty"),
    )


def claims_agg(t: Tables, yearly: bool = False) -> DataFrame:
    """Typed monthly claim aggregates (stg_claims_agg shape). ``yearly`` drops
    status from the grain and uses 'yyyy-01' as month: groups of hundreds of
    claims, which exercises the 28-day wrap of D5."""
    lines = _agg_lines(t, yearly)
    keys = ["provider_id", "region_id", "treatment_category", "claim_month"] + ([] if yearly else ["claim_status"])
    agg = lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("claim_count"),
        F.sum("billed_dec").cast("double").alias("total_billed"),
        F.round(F.sum("reimb_dec"), 2).cast("double").alias("total_reimbursed"),
    )
    status = F.lit(None).cast("string") if yearly else F.col("claim_status")
    return agg.select("provider_id", "region_id", "treatment_category", "claim_month", "claim_count",
                      "total_billed", "total_reimbursed", status.alias("claim_status"))


def large_claims_agg(t: Tables) -> DataFrame:
    """Typed claim aggregates of which some hold more cents than 64 bits."""
    large = F.pmod(F.col("claim_count"), F.lit(5)) == 0
    return claims_agg(t).withColumns({
        "total_billed": F.when(large, F.lit(2e17)).otherwise(F.col("total_billed")),
        "total_reimbursed": F.when(large, F.lit(1.5e17)).otherwise(F.col("total_reimbursed"))})


def prescriptions_agg(t: Tables) -> DataFrame:
    lines = _agg_lines(t, yearly=False)
    agg = lines.groupBy("provider_id", "region_id", "treatment_category", "claim_month").agg(
        F.count(F.lit(1)).alias("prescription_count"),
        F.sum("qty").alias("total_quantity"),
    )
    return agg.select("provider_id", "region_id", "treatment_category", "claim_month", "prescription_count",
                      "total_quantity")


# --- dirty raw text versions, for the cleaning operators C1-C4 ---

def raw_providers(t: Tables) -> DataFrame:
    """Every supplier twice: a padded / mixed-case copy and a second copy
    with another payload (so de-duplication has a real choice)."""
    p = providers(t)
    k = F.substring(F.col("provider_id"), -1, 1).cast("int")
    dirty = p.select(
        F.concat(F.lit("  "), F.lower("provider_id"), F.lit(" ")).alias("provider_id"),
        F.concat(F.lit(" "), F.col("provider_name"), F.lit("  ")).alias("provider_name"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit(None).cast("string")).otherwise(
            F.upper(F.concat(F.col("provider_type"), F.lit(" ")))).alias("provider_type"),
        F.lower("region_id").alias("region_id"),
    )
    other = p.select(
        "provider_id",
        F.concat(F.col("provider_name"), F.lit(" (branch)")).alias("provider_name"),
        "provider_type",
        "region_id",
    )
    return dirty.unionByName(other)


def raw_regions(t: Tables) -> DataFrame:
    r = regions(t)
    return r.select(
        F.concat(F.lit(" "), F.lower("region_id")).alias("region_id"),
        F.concat(F.col("region_name"), F.lit(" ")).alias("region_name"),
        F.upper("population_group").alias("population_group"),
    ).unionByName(r.select("region_id", F.lower("region_name").alias("region_name"), "population_group"))


# Fixed forms of a name ({n}) that a CSV must quote, double or keep as it is.
CSV_NAMES = ("{n}", "{n}, Ltd", 'The "{n}"', "{n}\nBranch", '"{n}",\r\n"x"', "C:\\{n}\\", "", None, " {n} ", '""', '\\"{n}')


def csv_records(t: Tables) -> DataFrame:
    """Customers with names in every form; the note has another form than the name."""
    key = F.col("c_custkey")
    fill = {"n": F.col("c_name")}
    return t.customer.select(
        key.cast("string").alias("record_id"), _pick(CSV_NAMES, key, fill).alias("name"),
        _pick(CSV_NAMES, key + F.floor(key / len(CSV_NAMES)).cast("bigint") + 1, fill).alias("note"))


# Fixed dirt vocabulary for text counts, months and statuses (chosen by a
# key derived from the row, never used to drop rows).
DIRTY_COUNTS = ("{n}", "{n}.0", "{n}.9", " {n} ", "0", "-3", "abc", None, "1e2", "+{n}", "3000000000", ".5", "99999999999999999999")
LARGE_AMOUNT = "20000000000000000.00"
DIRTY_MONTHS = ("{m}", "{m}-15", "bad", None, "{y}-13", " {m}")
DIRTY_STATUSES = ("{s}", "  {S} ", None, "", "{S}")


def _pick(options: tuple[str | None, ...], sel: Column, fill: dict[str, Column]) -> Column:
    out = F.lit(None).cast("string")
    m = F.pmod(sel, F.lit(len(options)))
    for i, opt in reversed(list(enumerate(options))):
        if opt is None:
            val = F.lit(None).cast("string")
        else:
            parts, rest = [], opt
            while "{" in rest:
                pre, tail = rest.split("{", 1)
                name, rest = tail.split("}", 1)
                if pre:
                    parts.append(F.lit(pre))
                parts.append(fill[name])
            if rest:
                parts.append(F.lit(rest))
            val = F.concat(*parts) if len(parts) > 1 else (parts[0] if parts else F.lit(""))
        out = F.when(m == i, val).otherwise(out)
    return out


def raw_claims(t: Tables) -> DataFrame:
    a = claims_agg(t)
    sel = F.col("claim_count") + F.length("treatment_category")
    fill = {
        "n": F.col("claim_count").cast("string"),
        "m": F.col("claim_month"),
        "y": F.substring("claim_month", 1, 4),
        "s": F.col("claim_status"),
        "S": F.upper("claim_status"),
    }
    return a.select(
        F.concat(F.lit(" "), F.lower("provider_id")).alias("provider_id"),
        F.lower("region_id").alias("region_id"),
        F.upper("treatment_category").alias("treatment_category"),
        _pick(DIRTY_MONTHS, sel, fill).alias("claim_month"),
        _pick(DIRTY_COUNTS, sel + 1, fill).alias("claim_count"),
        F.when(F.pmod(sel, F.lit(11)) == 3, F.lit(LARGE_AMOUNT)).otherwise(
            F.format_string("%.2f", "total_billed")).alias("total_billed"),
        F.when(F.pmod(sel, F.lit(7)) == 0, F.lit("n/a")).otherwise(
            F.format_string("%.2f", "total_reimbursed")).alias("total_reimbursed"),
        _pick(DIRTY_STATUSES, sel + 2, fill).alias("claim_status"),
    )


def raw_prescriptions(t: Tables) -> DataFrame:
    a = prescriptions_agg(t)
    sel = F.col("prescription_count") + F.length("treatment_category")
    fill = {
        "n": F.col("prescription_count").cast("string"),
        "m": F.col("claim_month"),
        "y": F.substring("claim_month", 1, 4),
    }
    qty_fill = dict(fill, n=F.col("total_quantity").cast("string"))
    return a.select(
        F.concat(F.col("provider_id"), F.lit(" ")).alias("provider_id"),
        F.concat(F.lit(" "), F.col("region_id")).alias("region_id"),
        F.initcap("treatment_category").alias("treatment_category"),
        _pick(DIRTY_MONTHS, sel + 3, fill).alias("claim_month"),
        _pick(DIRTY_COUNTS, sel, fill).alias("prescription_count"),
        _pick(DIRTY_COUNTS, sel + 5, qty_fill).alias("total_quantity"),
    )


# --- curated tables with violations, so that every quality check has work ---

# A row breaks a rule when its key has this rest (modulus, rest).
BROKEN = {"no_patient": (97, 0), "unknown_patient": (89, 1), "unknown_provider": (83, 2), "status": (79, 3),
          "over": (73, 4), "negative": (71, 5), "unknown_treatment": (67, 6), "total": (61, 7)}


def _broken(rule: str, key: str) -> Column:
    modulus, rest = BROKEN[rule]
    return F.pmod(F.col(key), F.lit(modulus)) == rest


def break_claims(fact_claims: DataFrame) -> DataFrame:
    """fact_claims with null and unknown keys, statuses and amounts that no
    rule allows."""
    broken = lambda rule: _broken(rule, "claim_sk")
    return fact_claims.withColumns({
        "patient_sk": F.when(broken("no_patient"), F.lit(None)).when(broken("unknown_patient"), F.lit(-1)).otherwise(
            F.col("patient_sk")),
        "provider_sk": F.when(broken("unknown_provider"), F.lit(-1)).otherwise(F.col("provider_sk")),
        "claim_status": F.when(broken("status"), F.lit("void")).otherwise(F.col("claim_status")),
        "reimbursed_amount": F.when(broken("over"), F.col("billed_amount") + 1).otherwise(F.col("reimbursed_amount")),
        "billed_amount": F.when(broken("negative"), -F.col("billed_amount")).otherwise(F.col("billed_amount")),
    })


def break_prescriptions(fact_prescriptions: DataFrame) -> DataFrame:
    return fact_prescriptions.withColumn(
        "treatment_sk", F.when(_broken("unknown_treatment", "prescription_sk"), F.lit(-1)).otherwise(F.col("treatment_sk")))


def break_totals(fact_reimbursements: DataFrame) -> DataFrame:
    return fact_reimbursements.withColumn(
        "total_claims", F.col("total_claims") + F.when(_broken("total", "reimbursement_sk"), 1).otherwise(0))


# --- ingestion records, for the source reports ---

def ingestion_records(t: Tables) -> DataFrame:
    """One ingested source per nation: its suppliers are the records, every
    fourth nation came from its fallback file."""
    n, s = t.nation.select("n_nationkey", "n_name"), t.supplier.select("s_nationkey")
    held = s.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("records"))
    fallback = F.pmod(F.col("n_nationkey"), F.lit(4)) == 0
    return n.join(held, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(
        F.lower("n_name").alias("source_name"),
        F.concat(F.lit("https://example.org/"), F.lower("n_name"), F.lit(".csv")).alias("source_url"),
        F.when(fallback, F.lit("fallback_sample")).otherwise(F.lit("downloaded")).alias("status"),
        fallback.alias("used_fallback"),
        F.concat(F.lower("n_name"), F.lit("_sample.csv")).alias("fallback_file"),
        F.coalesce("records", F.lit(0)).alias("records"))
