"""Quarter pipeline movement: how the quarter's pipeline started and moved.

Sets (each one row per deal):
  starting   open at the anchor snapshot, closing in the quarter
  pulled in  close date moved from beyond the quarter into it (not starting)
  new        accepted/created in the quarter, closing in it (not starting, not pulled in)
  pushed     starting deals now closing after the quarter
  total      won or accepted deals closing in the quarter
  ghost      total deals in none of starting / pulled in / new

Two rule sets share this code; their differences are data (:class:`Preset`).
The coverage table of the third rule set lives in ``plans.coverage``.

Plan shape: one wide row per deal (current values, its anchor rows, its latest
qualifying move) carries the sets as boolean columns; the seed is an explode
of the rows each deal contributes; the outcome is one ``groupBy`` with
conditional sums.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.functions import dims
from pipewright.functions.money import money, usd
from pipewright.functions.nulls import cond_sum, na_subtract, round_half_up, safe_ratio
from pipewright.functions.periods import ReportParams
from pipewright.operators import joins
from pipewright.sources import crm

STARTING, PULLED, CLEAN_UP, NEW, PUSHED, TOTAL = (
    "Starting Pipe", "Pulled In", "Clean Up Pulled In", "New Pipe", "Pushed", "Total")


@dataclass(frozen=True)
class Preset:
    name: str
    types: tuple
    start_stage_excl: tuple      # on the snapshot row
    start_accept: str            # 'sao_le_anchor' (snapshot SAO) | 'created_le_anchor' (current created)
    start_from_snapshot: bool    # category/type/amount from the snapshot (else current)
    other_stage_excl: tuple      # pulled in and total
    new_stage_excl: tuple        # new and pushed
    pulled_sao_before_q: bool    # pulled in must be accepted before the quarter
    pulled_end_inclusive: bool   # current close <= q_end (else < q_end)
    clean_up_label: bool         # pulled-in deals split into 'Clean Up Pulled In'
    new_by_created: bool         # new = created in quarter (else accepted in quarter)
    ghost_label: str
    keys: tuple
    amount: str                  # 'software_or_expansion' | 'acv'


V3 = Preset(
    name="v3",
    types=(dims.TYPE_NEW, dims.TYPE_EXISTING, dims.TYPE_EXPANSION),
    start_stage_excl=("Temporary", "Data Quality", "Closed Lost"),
    start_accept="sao_le_anchor",
    start_from_snapshot=True,
    other_stage_excl=tuple(dims.HOUSEKEEPING_STAGES),
    new_stage_excl=tuple(dims.HOUSEKEEPING_STAGES),
    pulled_sao_before_q=True,
    pulled_end_inclusive=False,
    clean_up_label=True,
    new_by_created=False,
    ghost_label=NEW,
    keys=("Geo", "Category", "Product", "Segment", "LeadSource", "Type_Smooth", "CAM_or_SAM",
          "Expansion_Category"),
    amount="software_or_expansion",
)

V4 = Preset(
    name="v4",
    types=(dims.TYPE_NEW,),
    start_stage_excl=tuple(dims.EARLY_STAGES + dims.HOUSEKEEPING_STAGES + ["Closed Lost"]),
    start_accept="created_le_anchor",
    start_from_snapshot=False,
    other_stage_excl=tuple(dims.HOUSEKEEPING_STAGES),
    new_stage_excl=tuple(dims.EARLY_STAGES + dims.HOUSEKEEPING_STAGES),
    pulled_sao_before_q=False,
    pulled_end_inclusive=True,
    clean_up_label=False,
    new_by_created=True,
    ghost_label=STARTING,
    keys=("Geo", "Category", "Product", "Segment", "LeadSource", "Type"),
    amount="acv",
)

PRESETS = {"v3": V3, "v4": V4}

SET_COLUMNS = ["Id", "Category", "Type", "Region", "Segment", "Product", "QB_USD", "StageName", "CloseDate",
               "LeadSource", "Movement_Type", "SAO_Date", "User_Role", "CAM_or_SAM", "Expansion_Category"]


class Movement:
    """All sets of one report run, computed from one wide row per deal.

    Only deals that can be in a set are joined. Two kinds can:

    * ``closing``: deals that close in the quarter today (a date filter on the
      scan) LEFT JOIN the anchor snapshot LEFT JOIN the latest qualifying move;
    * ``started``: deals that close at another time today, but are in the
      filtered anchor snapshot (INNER JOIN; on a cluster Spark's runtime Bloom
      filter reduces the deals before they are exchanged). They can have left
      the quarter only, so moves do not matter.

    The snapshot and the moves are grouped by ``Id`` before. After the joins
    everything is narrow: set membership is a set of boolean columns (with the
    reports' precedence: starting, then pulled in, then new), and the seed is an
    ``explode`` of the rows each deal contributes. Owner, currency and product
    lookups follow the pruning. A single set reads only the branch it needs:
    ``total`` (and the won categories) neither snapshot nor change log.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, p: ReportParams, preset: Preset = V3,
                 snapshots: DataFrame | None = None, changes: DataFrame | None = None,
                 current: DataFrame | None = None, opportunity: DataFrame | None = None):
        """``opportunity`` / ``snapshots`` / ``changes`` replace the views derived
        from the test tables (e.g. landed tables bucketed by id); ``current``
        replaces the whole current-deal frame (micro tests)."""
        self.spark, self.sf_dir, self.p, self.pre = spark, sf_dir, p, preset
        self._snapshots = snapshots
        self._changes = changes
        self._opportunity = opportunity
        self._current = current
        self._written: DataFrame | None = None

    def checkpoint(self) -> "Movement":
        """Materialise the wide rows of the deals in a set in the shared checkpoint folder
        (``spark.checkpoint.dir``) so that several outputs written from this run
        read them once, and a lost executor recomputes from the checkpoint, not
        from the sources."""
        self._written = self.wide().checkpoint(eager=True)
        return self

    # ------------------------------------------------------------ inputs
    @property
    def current(self) -> DataFrame:
        """Every current deal with its USD amount, role class and product."""
        return self._enrich(self._base())

    def _base(self) -> DataFrame:
        """Current deals, test accounts dropped."""
        if self._current is not None:
            return self._current
        o = self._opportunity if self._opportunity is not None else crm.opportunity_core(self.spark, self.sf_dir)
        return o.where(F.col("Test_Account") == F.lit(False))

    def _enrich(self, df: DataFrame) -> DataFrame:
        """USD amount, owner role class and product; columns the wide table adds pass through."""
        if self._current is not None:
            return df
        s, sf = self.spark, self.sf_dir
        if "Product" not in df.columns:
            df = crm.with_products(s, sf, df)
        ct = crm.currency(s, sf)
        u = crm.user(s, sf).select(F.col("Id").alias("u_Id"), "UserRoleId")
        ur = crm.user_role(s, sf).select(F.col("Id").alias("ur_Id"), F.col("Name").alias("User_Role"))
        df = df.join(F.broadcast(ct), df.CurrencyIsoCode == ct.IsoCode, "left")
        df = (joins.lookup(df, u, "OwnerId", "u_Id", F.col("Id"))
                .join(F.broadcast(ur), F.col("UserRoleId") == F.col("ur_Id"), "left"))
        rate = F.col("ConversionRate")
        if self.pre.amount == "software_or_expansion":
            qb = F.coalesce(F.col("Software_QB"), F.col("RW_Expansion_Amount")) / rate
        else:
            qb = F.col("ACV_Bookings") / rate
        extra = [c for c in ("h_rows", "moved_at") if c in df.columns]
        return df.select(
            "Id", "Category", "Type", "Region", "Segment", "Product", qb.alias("QB_USD"), "StageName",
            "CloseDate", "CreatedDate", "LeadSource", "SAO_Date", "User_Role",
            dims.role_class(F.col("User_Role")).alias("CAM_or_SAM"), "Expansion_Category", *extra)

    def snapshot_at_anchor(self) -> DataFrame:
        """Point-in-time read of the snapshot table (partition filter on snapshot_date)."""
        snaps = self._snapshots if self._snapshots is not None else crm.history(self.spark, self.sf_dir, [self.p.anchor])
        return snaps.where(F.col("snapshot_date") == F.lit(self.p.anchor))

    def changes(self) -> DataFrame:
        return self._changes if self._changes is not None else crm.field_history(self.spark, self.sf_dir)

    # -------------------------------------------------------------- wide
    def _in_quarter(self, c: Column, inclusive_end: bool = False) -> Column:
        p = self.p
        end = (c <= F.lit(p.q_end)) if inclusive_end else (c < F.lit(p.q_end))
        return (c >= F.lit(p.q_start)) & end

    def _snap_rows(self) -> DataFrame:
        """Qualifying anchor-snapshot rows per id: (Id, h_rows array<struct>)."""
        pre, p = self.pre, self.p
        h = self.snapshot_at_anchor()
        h = h.where(~F.col("StageName").isin(list(pre.start_stage_excl))
                    & F.col("Type").isin(list(pre.types))
                    & self._in_quarter(F.col("CloseDate")))
        if pre.start_accept == "sao_le_anchor":
            h = h.where(F.col("SAO_Date") <= F.lit(p.anchor))
        if pre.start_from_snapshot:
            # labels and amount frozen at the anchor; identical rows count once
            row = F.struct(F.col("Category").alias("Category"), F.col("Type").alias("Type"),
                           round_half_up(F.coalesce("Software_USD", "Expansion_USD", "qb_usd"), 2).alias("QB_USD"),
                           F.lit(None).cast("double").alias("QB_USD_Snapshot"))
            agg = F.array_sort(F.collect_set(row))
        else:
            row = F.struct(F.lit(None).cast("string").alias("Category"), F.lit(None).cast("string").alias("Type"),
                           F.lit(None).cast("double").alias("QB_USD"), F.col("qb_usd").alias("QB_USD_Snapshot"))
            agg = F.collect_list(row)
        return h.groupBy(F.col("Id").alias("h_Id")).agg(agg.alias("h_rows"))

    def _moves(self) -> DataFrame:
        """Latest move of the close date from beyond the quarter into it, per id."""
        p = self.p
        ch = self.changes()
        old, new = F.col("OldValue").try_cast("date"), F.col("NewValue").try_cast("date")
        return (ch.where((F.col("field") == "CloseDate") & (old >= F.lit(p.q_end)) & (new < F.lit(p.q_end))
                         & (new >= F.lit(p.q_start)))
                  .groupBy(F.col("OpportunityId").alias("m_Id")).agg(F.max("CreatedDate").alias("moved_at")))

    def _closes_in_quarter(self) -> Column:
        """Close dates of every set that looks at today's close date; both ends of all rule sets."""
        return (F.col("CloseDate") >= F.lit(self.p.q_start)) & (F.col("CloseDate") <= F.lit(self.p.q_end))

    def _closing(self, joined: bool = True) -> DataFrame:
        """Deals closing in the quarter; ``joined``: with their anchor rows and latest move."""
        df = self._base().where(self._closes_in_quarter())
        if not joined:
            return df
        snap, moves = self._snap_rows(), self._moves()
        return (df.join(snap, F.col("Id") == F.col("h_Id"), "left")
                  .join(moves, F.col("Id") == F.col("m_Id"), "left").drop("h_Id", "m_Id"))

    def _started(self) -> DataFrame:
        """Deals of the anchor snapshot's set that do not close in the quarter any more."""
        df = self._base().where(~F.coalesce(self._closes_in_quarter(), F.lit(False))).join(self._snap_rows(), F.col("Id") == F.col("h_Id"))
        return df.withColumn("moved_at", F.lit(None).cast("timestamp_ntz")).drop("h_Id")

    def wide(self, parts: tuple = ("closing", "started")) -> DataFrame:
        """One row per deal that is in a set."""
        if self._written is not None:
            return self._written
        frames = [getattr(self, f"_{x}")() for x in parts]
        df = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
        flags = ["in_start", "in_pulled", "in_new", "in_total"]  # pushed is in start, ghost in total
        return self._flags(self._enrich(df)).where(F.greatest(*flags))

    def _flags(self, df: DataFrame) -> DataFrame:
        pre, p = self.pre, self.p

        def ok(c: Column) -> Column:  # a filter predicate: NULL is not true
            return F.coalesce(c, F.lit(False))

        stage, typ = F.col("StageName"), F.col("Type")
        type_ok = typ.isin(list(pre.types))
        accept = F.col("CreatedDate") if pre.new_by_created else F.col("SAO_Date")
        in_start = F.col("h_rows").isNotNull()
        if pre.start_accept == "created_le_anchor":
            in_start = in_start & ok(F.col("CreatedDate") <= F.lit(p.anchor))
        pulled = (F.col("moved_at").isNotNull() & ~stage.isin(list(pre.other_stage_excl)) & type_ok
                  & (F.col("CreatedDate") < F.lit(p.q_end))
                  & self._in_quarter(F.col("CloseDate"), pre.pulled_end_inclusive))
        if pre.pulled_sao_before_q:
            pulled = pulled & (F.col("SAO_Date") < F.lit(p.q_start))
        new = (~stage.isin(list(pre.new_stage_excl)) & type_ok & self._in_quarter(F.col("CloseDate"))
               & self._in_quarter(accept))
        pushed = (~stage.isin(list(pre.new_stage_excl)) & type_ok & (accept <= F.lit(p.anchor))
                  & (F.col("CloseDate") > F.lit(p.q_end)))
        total = (((stage == dims.STAGE_CLOSED_WON) | F.col("SAO_Date").isNotNull())
                 & ~stage.isin(list(pre.other_stage_excl)) & type_ok & self._in_quarter(F.col("CloseDate")))
        df = df.withColumn("in_start", ok(in_start))
        df = df.withColumn("in_pulled", ok(pulled) & ~F.col("in_start"))
        df = df.withColumn("in_new", ok(new) & ~F.col("in_start") & ~F.col("in_pulled"))
        df = df.withColumns({
            "in_pushed": ok(pushed) & F.col("in_start"),
            "in_total": ok(total)})
        df = df.withColumn("in_ghost", F.col("in_total") & ~F.col("in_start") & ~F.col("in_pulled") & ~F.col("in_new"))
        if pre.clean_up_label:
            moved = F.col("moved_at")
            pulled_label = (F.when((moved.cast("date") >= F.col("CloseDate")) & (stage == dims.STAGE_CLOSED_LOST),
                                   F.lit(CLEAN_UP))
                             .when(moved < F.lit(p.anchor).cast("timestamp_ntz"), F.lit(CLEAN_UP))
                             .otherwise(F.lit(PULLED)))
        else:
            pulled_label = F.lit(PULLED)
        return df.withColumn("pulled_label", pulled_label)

    def _rows(self, *parts: str) -> DataFrame:
        """One row per deal and set, of the branches in ``parts``."""
        cur = F.struct(F.col("Category"), F.col("Type"), F.col("QB_USD"))

        def row(label: Column | str, src: str, base: Column = cur, snap_amt: Column | None = None) -> Column:
            lab = F.lit(label) if isinstance(label, str) else label
            return F.struct(base["Category"].alias("Category"), base["Type"].alias("Type"),
                            base["QB_USD"].alias("QB_USD"), lab.alias("Movement_Type"), F.lit(src).alias("src"),
                            (snap_amt if snap_amt is not None else F.lit(None).cast("double")).alias("QB_USD_Snapshot"))

        if self.pre.start_from_snapshot:
            # category, type and amount as frozen at the anchor (a missing value stays missing)
            def start_base(h):
                return F.struct(h["Category"].alias("Category"), h["Type"].alias("Type"), h["QB_USD"].alias("QB_USD"))
        else:
            def start_base(h):
                return cur
        starts = F.transform(F.col("h_rows"), lambda h: row(STARTING, "starting", base=start_base(h),
                                                             snap_amt=h["QB_USD_Snapshot"]))
        others = F.array(
            F.when(F.col("in_new"), row(NEW, "new")),
            F.when(F.col("in_pulled"), row(F.col("pulled_label"), "pulled")),
            F.when(F.col("in_pushed"), row(PUSHED, "pushed")),
            F.when(F.col("in_ghost"), row(self.pre.ghost_label, "ghost")),
            F.when(F.col("in_total"), row(TOTAL, "total")))
        rows = F.when(F.col("in_start"), F.concat(starts, others)).otherwise(others)
        w = (self.wide(parts) if parts else self.wide()).withColumn("_r", F.explode(F.filter(rows, lambda x: x.isNotNull())))
        return w.select(
            "Id", F.col("_r.Category").alias("Category"), F.col("_r.Type").alias("Type"), "Region", "Segment",
            "Product", F.col("_r.QB_USD").alias("QB_USD"), "StageName", "CloseDate", "LeadSource",
            F.col("_r.Movement_Type").alias("Movement_Type"), "SAO_Date", "User_Role", "CAM_or_SAM", "Expansion_Category",
            F.col("_r.src").alias("src"), F.col("_r.QB_USD_Snapshot").alias("QB_USD_Snapshot"),
            (F.col("in_start") | F.col("in_ghost")).alias("is_starting"),
            F.col("in_pulled").alias("is_pulled"), F.col("in_new").alias("is_new"))

    # -------------------------------------------------------------- sets
    def _set(self, src: str, *parts: str, keep_snapshot: bool = False) -> DataFrame:
        df = self._rows(*parts).where(F.col("src") == src).select(*SET_COLUMNS, "src", "QB_USD_Snapshot")
        return df if keep_snapshot else df.drop("QB_USD_Snapshot")

    @property
    def starting(self) -> DataFrame:
        return self._set("starting", keep_snapshot=not self.pre.start_from_snapshot)

    @property
    def pulled_in(self) -> DataFrame:
        return self._set("pulled", "closing")

    @property
    def new_pipe(self) -> DataFrame:
        return self._set("new", "closing")

    @property
    def pushed(self) -> DataFrame:
        return self._set("pushed", "started")

    @property
    def total(self) -> DataFrame:
        """Read from the deals closing in the quarter alone."""
        if self._written is not None:
            return self._set("total")
        df = self._closing(joined=False).withColumns({"h_rows": F.lit(None).cast(self._snap_rows().schema["h_rows"].dataType),
                                                      "moved_at": F.lit(None).cast("timestamp_ntz")})
        df = self._flags(self._enrich(df)).where("in_total")
        return df.withColumns({"Movement_Type": F.lit(TOTAL), "src": F.lit("total")}).select(*SET_COLUMNS, "src")

    @property
    def ghost(self) -> DataFrame:
        return self._set("ghost", "closing")

    # ------------------------------------------------------------ output
    def seed(self, with_flags: bool = False) -> DataFrame:
        """Long table of all sets (ghosts appended to the starting set)."""
        df = self._rows().withColumns({
            "Geo": dims.geo(F.col("Region")),
            "Type_Smooth": F.when(F.col("Type") == dims.TYPE_EXPANSION, F.lit(dims.TYPE_EXISTING))
                            .otherwise(F.col("Type"))})
        if not with_flags:
            df = df.drop("src", "QB_USD_Snapshot", "is_starting", "is_pulled", "is_new")
        return df

    def outcome(self) -> DataFrame:
        """Quarter outcome: 10 measures per key combination of the preset."""
        p = self.p
        s = self.seed(with_flags=True)
        mt, st = F.col("Movement_Type"), F.col("StageName")
        qb = money(F.col("QB_USD"))
        won, lost, tot = st == dims.STAGE_CLOSED_WON, st == dims.STAGE_CLOSED_LOST, mt == TOTAL
        by_q_end = F.col("CloseDate") <= F.lit(p.q_end)
        agg = s.groupBy(*self.pre.keys).agg(
            cond_sum(mt == STARTING, qb).alias("sp"),
            cond_sum(mt == NEW, qb).alias("np"),
            cond_sum(mt == PULLED, qb).alias("pi"),
            cond_sum(mt == PUSHED, qb).alias("pu"),
            cond_sum(tot & won, qb).alias("tw"),
            cond_sum(won & F.col("is_starting") & tot & by_q_end, qb).alias("spw"),
            cond_sum(won & F.col("is_pulled") & tot, qb).alias("wpi"),
            cond_sum(won & F.col("is_new") & tot, qb).alias("wnp"),
            cond_sum(lost & F.col("is_starting") & tot & by_q_end, qb).alias("spl"))
        return agg.select(
            *self.pre.keys,
            usd(F.col("sp")).alias("Starting_Pipeline"),
            usd(F.col("np")).alias("New_Pipe"),
            usd(F.col("pi")).alias("Pulled_In"),
            usd(F.col("pu")).alias("Pushed"),
            usd(F.col("tw")).alias("Total_Won"),
            usd(F.col("spw")).alias("Starting_Pipeline_Won"),
            usd(F.col("wpi")).alias("Won_From_Pulled_In"),
            usd(F.col("wnp")).alias("Won_From_New_Pipe"),
            usd(F.col("spl")).alias("Starting_Pipeline_Lost"),
            safe_ratio(F.col("sp"), F.col("tw")).alias("Coverage_of_Closed_Won"))

    def won_by_category(self) -> DataFrame:
        """Won count and USD per category among the quarter's total deals."""
        t = self.total.where(F.col("StageName") == dims.STAGE_CLOSED_WON)
        return t.groupBy("Category").agg(usd(F.sum(money(F.col("QB_USD")))).alias("won"),
                                         F.count(F.lit(1)).alias("num"))

    def id_multiplicity(self) -> DataFrame:
        """How often each deal id appears in the seed; single won deals flagged.

        Read from the wide row (one per deal), so no shuffle is needed.
        """
        n = (F.when(F.col("in_start"), F.size("h_rows")).otherwise(F.lit(0))
             + sum(F.col(c).cast("int") for c in ["in_new", "in_pulled", "in_pushed", "in_ghost", "in_total"]))
        df = self.wide().select("Id", n.alias("n_rows"), "StageName").where(F.col("n_rows") > 0)
        return df.select("Id", F.col("n_rows").cast("long").alias("n_rows"),
                         F.when(F.col("n_rows") > 1, F.lit("more than once")).otherwise(F.lit("once")).alias("multiplicity"),
                         ((F.col("n_rows") == 1) & F.coalesce(F.col("StageName") == dims.STAGE_CLOSED_WON, F.lit(False)))
                         .alias("single_won"))

    def field_delta(self) -> DataFrame:
        """Starting deals: current minus snapshot USD, a missing side read as zero."""
        st = self.starting
        return st.select("Id", "QB_USD", "QB_USD_Snapshot",
                         na_subtract(F.col("QB_USD"), F.col("QB_USD_Snapshot")).alias("QB_USD_Delta"))


def public_set(df: DataFrame) -> DataFrame:
    """A set as reported: geography added, bookkeeping columns dropped."""
    return df.drop("src").withColumn("Geo", dims.geo(F.col("Region")))


def movement(spark: SparkSession, sf_dir: str, p: ReportParams, preset: str = "v3") -> Movement:
    if preset not in PRESETS:
        raise ValueError(f"unknown rule set {preset!r}; choose one of {sorted(PRESETS)} (v2 is plans.coverage)")
    return Movement(spark, sf_dir, p, PRESETS[preset])
