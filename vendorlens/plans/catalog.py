"""The session's tables: raw items -> clean items -> star schema, scores and
disruption results. Derived tables are written once to the shared folder
named by ``spark.checkpoint.dir`` (the Parquet hand-off that replaces the
reference's CSV files and database tables); everything after them is a lazy
DataFrame over those stored tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import disruption as D
from ..operators import features as FE
from ..operators import profile as P
from ..operators import scoring as S
from ..operators import star as ST
from ..operators import views as V
from ..schemas import as_imported
from ..session import shared_path
from ..sources.orders import SOURCE_COLUMNS, raw_order_items, raw_presence
from ..sources.tables import table_version


def clean_order_items(raw: DataFrame, threshold: float = C.SPARSE_THRESHOLD, profiled: DataFrame | None = None):
    """The cleaning chain. Returns (clean, validated): ``validated`` is the
    frame the validation counters are taken on (after null handling, before
    the lead-time filter). ``profiled``: rows with the same nulls (a stored
    copy, ``raw_presence``), which are counted in place of those of ``raw``."""
    df = C.normalise_columns(raw)
    fractions, counts = C.null_fractions(df if profiled is None else C.normalise_columns(profiled))
    df = C.drop_sparse_columns(df, threshold, fractions)
    df = C.impute_median(df, counts)
    df = C.drop_null_rows(df)
    validated = df
    df = C.drop_pii(df)
    df = C.parse_timestamps(df)
    df = FE.lead_time_days(df)
    df = C.filter_lead_time(df)
    df = FE.late_delivery_flag(df)
    df = FE.spend_per_order(df)
    df = FE.delivery_delay_days(df)
    df = FE.calendar_features(df)
    return df, validated


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write to a fresh folder under the shared checkpoint folder and read
    it back (cuts lineage; survives executor loss)."""
    path = shared_path(df.sparkSession, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_partials(fact: DataFrame, path: str) -> None:
    """Write the fact's partial aggregates by month. Only the months that
    ``fact`` has are (re)written, so after a change it is enough to pass the
    items of the changed months; the other months' partials stay."""
    (V.fact_partials(fact).hint("rebalance", "order_month").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("order_month").parquet(path))


class Catalog:
    """Tables of one data directory, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, vendor: str = "supplier",
                 category: str = "type", n_sim: int = D.N_SIMULATIONS, seed: int = D.SEED):
        self.spark = spark
        self.sf_dir = sf_dir
        self.vendor = vendor
        self.category = category
        self.n_sim = n_sim
        self.seed = seed

    # --- items -----------------------------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        return raw_order_items(self.spark, self.sf_dir, self.vendor, self.category)

    @cached_property
    def raw_stored(self) -> DataFrame:
        """The raw items written once: the counterpart of the raw file, which
        the queries that pass over it several times read. The clean build's
        rows keep the lead-time filter inside the join instead."""
        return write_table(self.raw, "raw_items")

    @cached_property
    def raw_full(self) -> DataFrame:
        """The raw items with the columns that cleaning removes or fills."""
        return write_table(self.raw_wide, "raw_full")

    @cached_property
    def raw_wide(self) -> DataFrame:
        """``raw_full`` for one pass over it: not stored."""
        return raw_order_items(self.spark, self.sf_dir, self.vendor, self.category, full=True)

    def presence(self, full: bool = False) -> DataFrame:
        """Where the raw items have values: what a profile of nulls counts on,
        with normalised names."""
        return C.normalise_columns(raw_presence(self.spark, self.sf_dir, self.vendor, self.category, full))

    @cached_property
    def _cleaned(self):
        return clean_order_items(self.raw, profiled=self.presence())

    @cached_property
    def validated(self) -> DataFrame:
        """Items after null handling, before the lead-time filter: what the
        validation counters are taken on (from the stored raw items)."""
        return clean_order_items(self.raw_stored)[1]

    @cached_property
    def items(self) -> DataFrame:
        """Filtered items with features, before the tier. Stored, so the
        tier quantiles and the final join read them instead of cleaning the
        raw items again."""
        return write_table(self._cleaned[0], "items")

    @cached_property
    def clean(self) -> DataFrame:
        """Clean items with vendor tier (the staging table)."""
        return write_table(FE.vendor_tier(self.items), "clean")

    # --- star schema -----------------------------------------------------
    @cached_property
    def dim_vendor(self) -> DataFrame:
        return write_table(ST.dim_vendor(self.clean), "dim_vendor")

    @cached_property
    def dim_product(self) -> DataFrame:
        return write_table(ST.dim_product(self.clean), "dim_product")

    @cached_property
    def dim_region(self) -> DataFrame:
        return write_table(ST.dim_region(self.clean), "dim_region")

    @cached_property
    def dim_date(self) -> DataFrame:
        return write_table(ST.dim_date(self.clean), "dim_date")

    @cached_property
    def fact(self) -> DataFrame:
        return write_table(ST.fact_orders(self.clean, self.dim_region), "fact_orders")

    # --- python-side results (and their typed "imported" copies) ---------
    @cached_property
    def vendor_risk_scores(self) -> DataFrame:
        return write_table(S.vendor_risk_scores(self.clean), "vendor_risk_scores")

    @cached_property
    def _disruption(self):
        return D.disruption_model(self.clean, self.n_sim, self.seed)

    @property
    def targets(self) -> DataFrame:
        return self._disruption[0]

    @property
    def target_stats(self) -> DataFrame:
        return self._disruption[1]

    @cached_property
    def monte_carlo_results(self) -> DataFrame:
        # fails when no target survives, like the reference's guard
        return D.require_rows(write_table(self._disruption[2], "monte_carlo_results"))

    @cached_property
    def top12(self) -> DataFrame:
        return write_table(D.dual_sourcing_topn(self.monte_carlo_results), "top12_dual_sourcing")

    @cached_property
    def scores_imported(self) -> DataFrame:
        return as_imported(self.vendor_risk_scores, "vendor_risk_scores")

    @cached_property
    def mc_imported(self) -> DataFrame:
        return as_imported(self.monte_carlo_results, "monte_carlo_results")

    @cached_property
    def top12_imported(self) -> DataFrame:
        return as_imported(self.top12, "top12_dual_sourcing")


    # --- stored cardinality sketches of the raw items, by order month
    @cached_property
    def sketches(self) -> DataFrame:
        raw = C.normalise_columns(self.raw_stored)
        month = (F.year("order_date_dateorders") * 100 + F.month("order_date_dateorders")).alias("order_month")
        return write_table(P.cardinality_sketches(raw.select("*", month), ["order_month"]), "cardinality", ["order_month"])

    # --- stored partial aggregates: the only scans of the fact by the views
    @cached_property
    def partials(self) -> DataFrame:
        """The fact's mergeable aggregates, partitioned by month."""
        path = shared_path(self.spark, "fact_partials")
        write_partials(self.fact, path)
        return self.spark.read.parquet(path)

    @cached_property
    def category_vendor(self) -> DataFrame:
        return write_table(V.category_vendor(self.partials, self.dim_product), "category_vendor")

    # --- shared views (their size-checked small sides are measured once)
    @cached_property
    def vw_category_hhi(self) -> DataFrame:
        return write_table(V.vw_category_hhi(self.category_vendor, self.dim_product), "vw_category_hhi")

    @cached_property
    def vw_hhi_by_category(self) -> DataFrame:
        return V.vw_hhi_by_category(self.vw_category_hhi)

    @cached_property
    def vw_single_source(self) -> DataFrame:
        return V.vw_single_source(self.vw_category_hhi, self.vw_hhi_by_category)

    @cached_property
    def vw_vendor_risk_master(self) -> DataFrame:
        return V.vw_vendor_risk_master(self.partials, self.dim_vendor, self.scores_imported)

    # --- SQL access --------------------------------------------------------
    def register_views(self) -> list[str]:
        """Name every stored table and every reporting view in the session,
        so the reference's queries run as ``spark.sql("SELECT ... FROM
        vw_kpi_summary")``. Views stay lazy DataFrames over the stored
        tables."""
        hhi, by_cat, single = self.vw_category_hhi, self.vw_hhi_by_category, self.vw_single_source
        master = self.vw_vendor_risk_master
        named = {
            "staging_orders": self.clean,
            "dim_vendor": self.dim_vendor,
            "dim_product": self.dim_product,
            "dim_region": self.dim_region,
            "dim_date": self.dim_date,
            "fact_orders": self.fact,
            "vendor_risk_scores": self.scores_imported,
            "monte_carlo_results": self.mc_imported,
            "top12_dual_sourcing": self.top12_imported,
            "vw_vendor_spend": V.vw_vendor_spend(self.partials, self.dim_vendor),
            "vw_vendor_lead_time": V.vw_vendor_lead_time(self.partials, self.dim_vendor),
            "vw_vendor_late_rate": V.vw_vendor_late_rate(self.partials, self.dim_vendor),
            "vw_category_hhi": hhi,
            "vw_hhi_by_category": by_cat,
            "vw_single_source": single,
            "vw_disruption_exposure": V.vw_disruption_exposure(single, self.partials, self.dim_vendor, by_cat),
            "vw_vendor_risk_master": master,
            "vw_dual_sourcing_recommendations": V.vw_dual_sourcing_recommendations(
                self.top12_imported, self.dim_vendor),
            "vw_kpi_summary": V.vw_kpi_summary(self.category_vendor, self.dim_product, self.mc_imported,
                                               self.scores_imported, self.top12_imported),
            "vw_category_concentration": V.vw_category_concentration(
                self.category_vendor, self.dim_product, self.dim_vendor, by_cat, single),
            "vw_yoy_spend": V.vw_yoy_spend(self.fact, self.dim_vendor, self.dim_date),
        }
        for name, df in named.items():
            df.createOrReplaceTempView(name)
        return list(named)


_CATALOGS: dict = {}


def catalog_for(spark: SparkSession, sf_dir: str, **kw) -> Catalog:
    """One catalog per (application, data directory, bindings), built anew when
    a source table has changed since."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), tuple(sorted(kw.items())))
    versions = tuple(table_version(spark, sf_dir, t) for t in SOURCE_COLUMNS)
    cat, known = _CATALOGS.get(key, (None, None))
    if cat is None or cat.spark is not spark or known != versions:
        cat = Catalog(spark, sf_dir, **kw)
        _CATALOGS[key] = cat, versions
    return cat
