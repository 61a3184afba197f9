"""The gold star schema as a lazy model.

``GoldModel`` wires silver feeds → dimensions → facts → attribution facts.
Every table is a DataFrame built on first access; nothing runs until an
action.  The same object serves three uses:

* analytic queries over the driver's tables (``GoldModel.from_driver``);
* the load job that materialises gold as parquet (``materialize``);
* analytic queries over an already materialised gold layer
  (``GoldModel.from_tables``), which is how the reference runs its views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import attribution, dims, facts
from ..sources.binding import silver_from_driver
from ..sources.driver import DriverTables
from ..sources.staging import staged

GOLD_TABLES = ("dim_date", "dim_user", "dim_campaign", "dim_channel",
               "fact_spend", "fact_clicks", "fact_sessions", "fact_touchpoints", "fact_purchases",
               "fact_touchpath", "fact_attribution_linear", "fact_attribution_last_touch")

# Facts written partitioned by month (SRC-03): table → date column.  The
# partition column ``part_month`` (first day of the month) lets month
# filters prune files; ``from_tables`` keeps it available.
FACT_MONTH = {
    "fact_spend": "spend_date", "fact_clicks": "click_timestamp", "fact_sessions": "session_date",
    "fact_touchpoints": "tp_date", "fact_purchases": "purchase_date", "fact_touchpath": "touchpoint_time",
    "fact_attribution_linear": "purchase_date", "fact_attribution_last_touch": "purchase_date",
}
PART_COL = "part_month"

# Natural keys that order the surrogate keys of the materialised tables.
SURROGATE_KEYS = {
    "dim_user": ("user_key", ["user_id"]),
    "dim_campaign": ("campaign_key", ["campaign_id"]),
    "dim_channel": ("channel_key", ["channel_name"]),
}

# Surrogate keys of the facts and an order under which rows that tie are equal.
# The load job numbers facts as they are produced; the order serves comparison.
FACT_KEYS = {
    "fact_spend": ("spend_key", ["spend_date", "channel", "campaign_id", "spend"]),
    "fact_clicks": ("clicks_key", ["click_id", "click_timestamp", "user_id", "click_channel", "campaign_id"]),
    "fact_sessions": ("session_key", ["session_id", "session_start", "user_id", "device_category", "source_channel", "pages_viewed"]),
    "fact_touchpoints": ("touchpoint_key", ["user_id", "touchpoint_time", "channel", "campaign_id", "interaction_type"]),
    "fact_purchases": ("purchase_key", ["purchase_id"]),
    "fact_touchpath": ("touchpath_key", ["purchase_id", "touchpoint_number"]),
    "fact_attribution_linear": ("attribution_key", ["purchase_id", "touchpoint_number"]),
    "fact_attribution_last_touch": ("attribution_key", ["purchase_id"]),
}

# Facts of path rows, whose keys follow from the path lengths of their purchases.
PATH_FACTS = ("fact_touchpath", "fact_attribution_linear")

# The calendar spans whole years from the first to the last event of any dated
# feed, so that every event finds its date key.
CALENDAR_SOURCES = (("mrkt_ad_spend", "spend_date"), ("mrkt_clicks", "click_timestamp"), ("web_sessions", "session_start"),
                    ("web_touchpoints", "touchpoint_time"), ("crm_purchases", "purchase_date"))
# The driver tables' columns behind those feeds: one narrow scan each, no joins.
DRIVER_DATES = (("lineitem", "l_shipdate"), ("events", "ts"), ("orders", "o_orderdate"))


class GoldModel:
    def __init__(self, spark: SparkSession, silver: dict[str, DataFrame] | None = None,
                 tables: dict[str, DataFrame] | None = None,
                 calendar: tuple[str, str] | None = None, attribution_opts: dict | None = None):
        self.spark = spark
        self.silver = silver or {}
        self.calendar = calendar
        self.attribution_opts = attribution_opts or {}
        self._t: dict[str, DataFrame] = dict(tables or {})

    # -- constructors --------------------------------------------------------
    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, **kw) -> "GoldModel":
        t = DriverTables(spark, sf_dir)
        kw["attribution_opts"] = {"stage": True, **(kw.get("attribution_opts") or {})}
        m = cls(spark, silver=silver_from_driver(t), **kw)
        m._t["_driver"] = t
        return m

    @property
    def driver(self) -> DriverTables:
        return self._t["_driver"]

    @classmethod
    def from_tables(cls, spark: SparkSession, root: str, keep_partition_column: bool = False,
                    keep_fact_keys: bool = False, **kw) -> "GoldModel":
        """Gold tables written by ``materialize``.  The month partition column and
        the facts' keys are dropped unless asked for, so schemas equal ``from_driver``'s."""
        tables = {}
        for n in GOLD_TABLES:
            df = spark.read.parquet(f"{root.rstrip('/')}/{n}")
            if PART_COL in df.columns and not keep_partition_column:
                df = df.drop(PART_COL)
            if n in FACT_KEYS and not keep_fact_keys:
                df = df.drop(FACT_KEYS[n][0])
            tables[n] = df
        return cls(spark, tables=tables, **kw)

    # -- access --------------------------------------------------------------
    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in self._t:
            return self._t[name]
        builder = getattr(type(self), f"_build_{name}", None)
        if builder is None:
            raise AttributeError(name)
        df = builder(self)
        if isinstance(df, dict):
            self._t.update(df)
            return self._t[name]
        self._t[name] = df
        return df

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def keyed_fact(self, name: str) -> DataFrame:
        """The fact with its dense key over its whole order."""
        key, order = FACT_KEYS[name]
        if name in PATH_FACTS and self.silver and self.attribution_opts.get("method", "rank") == "rank":
            return attribution.keyed_path_facts(self.silver["web_touchpoints"], self.silver["crm_purchases"],
                                                name, key, **{k: v for k, v in self.attribution_opts.items() if k != "method"})
        return dims.with_dense_key(self.table(name), key, order)

    def sharing(self, *feeds: str) -> "GoldModel":
        """This model with the named feeds written once, for queries that read several tables built on them."""
        if not self.silver:
            return self
        if "_sharing" not in self._t:
            written = {n: staged(self.silver[n], f"feed-{n}") for n in feeds}
            m = GoldModel(self.spark, silver={**self.silver, **written}, calendar=self.calendar, attribution_opts=self.attribution_opts)
            if "_driver" in self._t:
                m._t["_driver"] = self._t["_driver"]
            self._t["_sharing"] = m
        return self._t["_sharing"]

    # -- builders ------------------------------------------------------------
    def _build_dim_date(self):
        """Calendar over whole years from the first to the last event, unless
        an explicit (start, end) was given."""
        if self.calendar:
            return dims.dim_date(self.spark, *self.calendar)
        if "_driver" in self._t:
            dated = [(self.driver.__getattr__(t), c) for t, c in DRIVER_DATES]
        else:
            dated = [(self.silver[t], c) for t, c in CALENDAR_SOURCES]
        return dims.dim_date(self.spark, *dims.calendar_bounds(*dated))

    def _build_dim_user(self):
        s = self.silver
        return dims.dim_user(s["web_sessions"], s["mrkt_clicks"], s["web_touchpoints"],
                             s["crm_purchases"], s["crm_user_acquisitions"])

    def _build_dim_campaign(self):
        return dims.dim_campaign(self.silver["mrkt_campaigns"])

    def _build_dim_channel(self):
        return dims.dim_channel(self.silver["crm_channels"])

    def _build_first_acquisition(self):
        return facts.first_acquisition(self.silver["crm_user_acquisitions"])

    def _build_fact_spend(self):
        return facts.fact_spend(self.silver["mrkt_ad_spend"], self.dim_date, self.silver["mrkt_campaigns"])

    def _build_fact_clicks(self):
        return facts.fact_clicks(self.silver["mrkt_clicks"], self.dim_date, self.first_acquisition)

    def _build_fact_sessions(self):
        return facts.fact_sessions(self.silver["web_sessions"], self.dim_date, self.first_acquisition)

    def _build_fact_touchpoints(self):
        return facts.fact_touchpoints(self.silver["web_touchpoints"], self.dim_date, self.silver["mrkt_campaigns"])

    def _build_fact_purchases(self):
        return facts.fact_purchases(self.silver["crm_purchases"], self.dim_date, self.first_acquisition)

    def _attribution(self):
        return attribution.attribution_facts(self.silver["web_touchpoints"], self.silver["crm_purchases"],
                                             **self.attribution_opts)

    _build_fact_touchpath = _attribution
    _build_fact_attribution_linear = _attribution
    _build_fact_attribution_last_touch = _attribution

    def _build_path_lengths(self):
        """ATT-04: from daily counts; from the written path where there are no feeds."""
        if self.silver:
            return attribution.path_length_per_purchase(self.silver["web_touchpoints"], self.silver["crm_purchases"])
        return attribution.path_lengths(self.fact_touchpath)

    def _build_fact_user_acquisition(self):
        return attribution.first_touch(self.fact_touchpoints)

    # -- materialisation (SRC-03 / SRC-05) ------------------------------------
    def materialize(self, root: str, with_keys: bool = True, stage_silver: bool = True,
                    partition_facts: bool = True, catalog: str | None = None) -> DataFrame:
        """Gold load job: write every gold table as parquet under
        ``<root>/gold/<table>`` (overwrite = the reference's drop / create /
        insert), dimensions and facts with their dense surrogate keys; returns the
        audit table (layer, table, rows, seconds, status).  Reload with
        ``GoldModel.from_tables(spark, f"{root}/gold")``.

        With ``stage_silver`` the silver feeds are written first
        (``<root>/silver/<feed>``) and gold is built from the written tables:
        each feed is computed once although several gold tables read it,
        and the written tables cut the lineage (a lost executor recomputes
        from them, not from the raw sources).  ``catalog`` also registers what
        was written, in the databases ``<catalog>_silver`` and
        ``<catalog>_gold`` (SRC-06)."""
        from ..sources.bronze import layer_path, run_layer
        from ..sources.catalog import create_layers, register_table

        audits = []
        model = self
        if stage_silver and self.silver:
            audits.append(run_layer(self.spark, "silver",
                                    {n: (lambda df=df: df) for n, df in self.silver.items()}, root))
            written = {n: self.spark.read.parquet(layer_path(root, "silver", n)) for n in self.silver}
            model = GoldModel(self.spark, silver=written, calendar=self.calendar,
                              attribution_opts={"stage": True, "bucket": "range", **self.attribution_opts})

        def job(name):
            df = model.table(name)
            if with_keys and name in SURROGATE_KEYS:
                key, order = SURROGATE_KEYS[name]
                df = dims.with_dense_key(df, key, order)
            if with_keys and name in FACT_KEYS:
                df = dims.with_dense_key(df, FACT_KEYS[name][0])
            if partition_facts and name in FACT_MONTH:
                df = df.withColumn(PART_COL, F.trunc(F.to_date(FACT_MONTH[name]), "MM"))
            return df

        parts = {n: [PART_COL] for n in FACT_MONTH} if partition_facts else None
        audits.append(run_layer(self.spark, "gold", {n: (lambda n=n: job(n)) for n in GOLD_TABLES}, root, parts))
        if catalog:
            create_layers(self.spark, catalog, root)
            for layer, names in (("silver", self.silver if stage_silver else ()), ("gold", GOLD_TABLES)):
                for n in names:
                    register_table(self.spark, f"{catalog}_{layer}", n, layer_path(root, layer, n))
        out = audits[0]
        for a in audits[1:]:
            out = out.unionByName(a)
        return out
