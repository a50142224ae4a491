"""One-day sync and backfill (M-01..M-03, A-13, A-15..A-17, J-*, K-01..K-03).

Order follows the data dependencies: agents -> groups (members are checked
against merged agents); roles -> agent_roles (pairs checked against merged
roles); budgets, cards, transactions. Agents and groups are mandatory, the
rest are skipped when their folder is absent.

Per entity: read the day's snapshot with the declared schema -> transform
(normalize, validate, dedup, reference checks) -> quarantine folder -> staging
folder -> merge into the core table. Counts ride on these writes as
observations. Every stage boundary is a written table, so lineage never spans
more than one step.

A run of a day has a number. Complete tables get that number as their
version, merged from the last version below it; bucketed tables are staged
under it and switched; history and metrics are folders of it; and a step ends
with its marker in the ledger. So a run that died is taken up where it stopped:
committed steps are skipped, and a step without a marker is done again from
the same inputs, with the same result.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from syncforge import schemas as S
from syncforge.functions import try_long
from syncforge.operators.assignments import merge_assignments
from syncforge.operators.changes import assignment_changes
from syncforge.operators.dedup import drop_null_keys
from syncforge.operators.envelope import unwrap
from syncforge.operators.hierarchy import DESCENDANTS, groups_with_active_members, update_inactive
from syncforge.operators.membership import replace_members
from syncforge.operators.merge import ACTION, merge_latest
from syncforge.operators.metrics import observed_counts, report_of, run_metrics_row
from syncforge.operators.refer import deactivate_absent
from syncforge.operators.snapshot import status_snapshot
from syncforge.operators.validate import to_quarantine
from syncforge.operators.watermark import advance_watermark, since_watermark
from syncforge.plans.entities import agent_roles, agents, budgets, cards, groups, roles, transactions
from syncforge.sinks.keyindex import KeyIndex
from syncforge.sinks.tables import BUCKET, TableStore
from syncforge.sources.readers import path_exists, read
from syncforge.sources.snapshots import read_day

QUARANTINE = "quarantine"
METRICS = "pipeline_metrics"
STATE = "pipeline_state"
ROLE_HISTORY = "agent_role_history"
STATUS_HISTORY = "agent_status_history"
STG_DAY = "stg_day"
CLASHES = "_clashes"  # keys and owners found to clash, read back while a batch is split
OWN_ACTIVE = "groups_own_active"  # groups with an active member of their own, as of each run


class MissingMandatoryEntity(RuntimeError):
    pass


@dataclass
class DayContext:
    spark: SparkSession
    base: str
    day: str
    store: TableStore
    run_ts: dt.datetime
    run_id: str
    fx_rates: DataFrame | None = None
    direction: str = DESCENDANTS
    delta_only: bool = False
    mark_absent: bool = False
    multiline: bool = True  # one JSON document per file (API export); False = JSON-lines, splittable
    rebalance: bool = False  # spread records of few huge export files over many tasks (AQE rebalance)
    day_date: dt.date | None = None
    raw: dict[str, DataFrame] = field(default_factory=dict)  # records handed over instead of read
    run: int = 0  # number of this run of the day; drawn from the ledger where it is not given
    results: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.run = self.run or self.store.run_number(self.day)


# ---------------------------------------------------------------------------
# shared steps
# ---------------------------------------------------------------------------
@contextmanager
def _fork(ctx: DayContext):
    """Frames persisted at the valid/quarantine fork, released after both writes."""
    hold: list = []
    try:
        yield hold
    finally:
        for h in hold:
            h.unpersist()


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """E-06: the row count rides on the write itself (no extra job)."""
    obs = Observation()
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _quarantine(ctx: DayContext, errors: DataFrame, name: str) -> None:
    df, obs = _observed(errors.drop("sync_day"))
    ctx.store.overwrite_folder(QUARANTINE, df, step=name, sync_day=ctx.day)
    ctx.results.setdefault("quarantined_rows", {})[name] = obs.get.get("rows", 0)


def _stage(ctx: DayContext, name: str, valid: DataFrame) -> DataFrame:
    table = f"stg_{name}"
    df, obs = _observed(valid)
    staged = ctx.store.overwrite_folder(table, df, **{STG_DAY: ctx.day})
    ctx.results.setdefault("staged_rows", {})[name] = obs.get.get("rows", 0)
    return staged


def _write_core(ctx: DayContext, table: str, merged: DataFrame, *more) -> tuple[DataFrame, Observation]:
    """The table's version of this run, and the counts of its write."""
    df, seen = observed_counts(merged, *more)
    ctx.store.write_version(table, df, ctx.run)
    return ctx.spark.read.schema(df.schema).parquet(f"{ctx.store.path(table)}/v={ctx.run}"), seen


# Large entities fed by daily deltas: tables bucketed by key (see sinks.tables).
BUCKETED = {
    "transactions": (S.TRANSACTIONS_DDL, ["transaction_id"]),
    "cards": (S.CARDS_DDL, ["card_id"]),
    "budgets": (S.BUDGETS_DDL, ["budget_id"]),
}


def read_core(store: TableStore, table: str, ddl: str | None = None) -> DataFrame:
    """Current state of a core table, whichever layout it uses."""
    if table in BUCKETED:
        return store.read_buckets(table, BUCKETED[table][0]).drop(BUCKET)
    return store.read(table, ddl)


def key_index(store: TableStore) -> KeyIndex:
    return KeyIndex(store, "transactions", "idempotency_key", "transaction_id")


def merge_buckets(store: TableStore, table: str, staged: DataFrame, **merge_kw) -> DataFrame:
    """Next state of the buckets that the staged keys fall into: the table's columns, ``_action``, ``bucket``."""
    ddl, keys = BUCKETED[table]
    stored = store.read_buckets(table, ddl, store.touched(staged, *keys)).drop(BUCKET)
    return merge_latest(stored, staged, keys, **merge_kw).withColumn(BUCKET, store.bucket(*keys))


def _merge_bucketed(ctx: DayContext, table: str, staged: DataFrame, index: bool = False, **merge_kw) -> dict:
    """Merge into the touched buckets of a table; returns the counts. What a dead run has staged is used as it is."""
    store, note = ctx.store, f"_switch/run={ctx.run}/{table}_counts"
    ddl, keys = BUCKETED[table]
    if store.staged_buckets(table, ctx.run) is None or store.read_note(note) is None:
        merged, seen = observed_counts(merge_buckets(store, table, staged, **merge_kw))
        store.stage_buckets(table, ctx.run, merged.drop(ACTION))
        store.write_note(note, report_of(seen.get))
    if index:
        own = key_index(store)
        if not own.staged(ctx.run):
            pair = [*keys, own.key]
            after = ctx.spark.read.schema(f"{ddl}, {BUCKET} int").parquet(store.staged_buckets(table, ctx.run)).select(*pair)
            before = store.read_buckets(table, ddl, store.touched(staged, *keys)).select(*pair)
            diff = after.withColumn("n", F.lit(1)).unionByName(before.withColumn("n", F.lit(-1))).groupBy(*pair).agg(F.sum("n").alias("n")).where("n <> 0")
            changes = store.write_staged(f"{table}_key_changes", ctx.run, diff)  # one shuffle of both sides; read by each step of the index
            own.stage(ctx.run, added=changes.where("n > 0").select(*pair), released=changes.where("n < 0").select(*pair))
        store.switch_buckets(table, ctx.run)
        own.switch(ctx.run)
    else:
        store.switch_buckets(table, ctx.run)
    return store.read_note(note)


def _metrics(ctx: DayContext, name: str, table: str, counts: dict, started: dt.datetime) -> None:
    m = run_metrics_row(ctx.spark, counts, name, table, ctx.day, started, _now(), run_id=ctx.run_id)
    ctx.store.overwrite_folder(METRICS, m.drop("day"), run=ctx.run, step=name, day=ctx.day)
    ctx.results[name] = counts


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _read(ctx: DayContext, name: str) -> tuple[DataFrame, bool]:
    """The day's snapshot of one source; with ``ctx.rebalance`` the records
    are unwrapped right after the scan and rebalanced by AQE, so a single
    huge (unsplittable) export file does not keep all the parsing,
    validation and FX work in one task. Transforms accept flat records."""
    if name in ctx.raw:
        return ctx.raw[name], True
    raw, ok = read_day(ctx.spark, ctx.base, ctx.day, name, ctx.multiline)
    if ok and ctx.rebalance:
        wrapper = "budget" if name == "budgets" else None
        lineage = [c for c in (S.FILE, S.FILE_TIME) if c in raw.columns]
        raw = unwrap(raw, "results", wrapper=wrapper, carry=lineage).select("rec.*", *lineage).hint("rebalance")
    return raw, ok


# ---------------------------------------------------------------------------
# entities
# ---------------------------------------------------------------------------
def sync_agents(ctx: DayContext) -> bool:
    started = _now()
    details, ok_d = _read(ctx, "agent_details")
    active, ok_a = _read(ctx, "agents")
    if not (ok_d and ok_a):
        raise MissingMandatoryEntity(f"agents snapshot missing for {ctx.day}")
    with _fork(ctx) as hold:
        valid, errors = agents.transform(details, active, ctx.day, ctx.run_ts, hold=hold)
        unread = agents.unread_lists(active, ctx.day, ctx.run_ts)
        _quarantine(ctx, errors.unionByName(unread), "agents")
        core = ctx.store.read("agents", S.AGENTS_DDL, below=ctx.run)
        if not unread.isEmpty():  # part of the list is missing: nobody becomes inactive by it
            valid = agents.keep_status(valid, core)
        staged = _stage(ctx, "agents", valid)
    merged = merge_latest(
        core, staged, ["agent_id"], guard="updated_at", null_guard="reject",
        keep=["created_at"], greatest=["updated_at"],
    )
    if ctx.mark_absent:
        ids = unwrap(details, "results").select(try_long("rec.id").alias("agent_id"))
        merged = deactivate_absent(merged, present=ids)
    written, seen = _write_core(ctx, "agents", merged)
    # J-03: the snapshot holds one sync date for every agent, so the upsert
    # keyed by (agent_id, sync_date) is exactly an overwrite of that date's
    # partition -- the history is never rewritten as a whole.
    ctx.store.overwrite_partitions(STATUS_HISTORY, status_snapshot(written, ctx.day_date), ["sync_date"])
    _metrics(ctx, "agents", "agents", report_of(seen.get), started)
    return True


def sync_groups(ctx: DayContext) -> bool:
    started = _now()
    raw, ok = _read(ctx, "groups")
    if not ok:
        raise MissingMandatoryEntity(f"groups snapshot missing for {ctx.day}")
    agents_now = ctx.store.read("agents", S.AGENTS_DDL)
    with _fork(ctx) as hold:
        g, members, snapshot_groups, errors = groups.transform(raw, agents_now, ctx.day, ctx.run_ts, hold=hold)
        _quarantine(ctx, errors, "groups")
        staged = _stage(ctx, "groups", g)
        staged_members = _stage(ctx, "group_membership", members)
        listed = _stage(ctx, "group_lists", snapshot_groups)
    core = ctx.store.read("groups", S.GROUPS_DDL, below=ctx.run)
    merged = merge_latest(core, staged, ["group_id"], keep=["created_at", "inactive"])
    # deleted = stored rows in (counted from the file footers: an observation is lost where AQE finds
    # its side of a shuffled join empty) - stored rows kept, observed on the write
    membership = ctx.store.read("group_membership", S.MEMBERSHIP_DDL, below=ctx.run)
    new_members, kept = _write_core(ctx, "group_membership", replace_members(membership, staged_members, listed))
    # inactive flag over the merged hierarchy, the new members and merged agents
    merged_groups, seen = _write_core(ctx, "groups_merged", merged)
    own = groups_with_active_members(new_members.drop(ACTION), agents_now)
    own_now, _ = _write_core(ctx, OWN_ACTIVE, own.withColumn(ACTION, F.lit(None).cast("string")))
    own_before = ctx.store.read(OWN_ACTIVE, "group_id bigint", below=ctx.run)
    flagged = update_inactive(merged_groups, core, own_before, own_now, direction=ctx.direction)
    _, flags = _write_core(ctx, "groups", flagged, F.count_if(F.col("_recomputed")).alias("rows_recomputed"))
    deleted = membership.count() - kept.get.get("rows_kept", 0)
    counts = report_of({**seen.get, "rows_deleted": deleted, "rows_recomputed": flags.get.get("rows_recomputed", 0)})
    _metrics(ctx, "groups", "groups", counts, started)
    return True


def sync_roles(ctx: DayContext) -> bool:
    started = _now()
    raw, ok = _read(ctx, "roles")
    if not ok:
        return False
    with _fork(ctx) as hold:
        valid, errors = roles.transform(raw, ctx.day, ctx.run_ts, hold=hold)
        _quarantine(ctx, errors, "roles")
        staged = _stage(ctx, "roles", valid)
    merged = merge_latest(ctx.store.read("roles", S.ROLES_DDL, below=ctx.run), staged, ["role_id"], keep=["created_at"])
    _, seen = _write_core(ctx, "roles", merged)
    _metrics(ctx, "roles", "roles", report_of(seen.get), started)
    return True


def sync_agent_roles(ctx: DayContext) -> bool:
    started = _now()
    details, ok = _read(ctx, "agent_details")
    if not ok or ctx.results.get("roles") == SKIPPED:
        return False
    master = ctx.store.read("roles", S.ROLES_DDL)
    known_agents = ctx.store.read("agents", S.AGENTS_DDL)
    pairs, errors, unread = agent_roles.transform(details, master, ctx.day, ctx.run_ts, agents=known_agents)
    _quarantine(ctx, errors, "agent_roles")
    staged = _stage(ctx, "agent_roles", pairs)
    current = ctx.store.read("agent_role_mapping", S.AGENT_ROLE_MAPPING_DDL, below=ctx.run)
    skipped = _stage(ctx, "agent_roles_unread", unread)
    written, seen = _write_core(ctx, "agent_role_mapping", merge_assignments(current, staged, ctx.run_ts, untouched=skipped))
    # J-07: the log is what the two versions differ in, so it can be derived again
    ctx.store.overwrite_folder(ROLE_HISTORY, assignment_changes(current, written.drop(ACTION)), run=ctx.run)
    _metrics(ctx, "agent_roles", "agent_role_mapping", report_of(seen.get), started)
    return True


def sync_budgets(ctx: DayContext) -> bool:
    started = _now()
    raw, ok = _read(ctx, "budgets")
    if not ok:
        return False
    with _fork(ctx) as hold:
        valid, errors = budgets.transform(raw, ctx.day, ctx.run_ts, hold=hold)
        _quarantine(ctx, errors, "budgets")
        staged = _stage(ctx, "budgets", valid)
    counts = _merge_bucketed(ctx, "budgets", budgets.to_core(staged, ctx.run_ts), keep=["created_at"])
    _metrics(ctx, "budgets", "budgets", counts, started)
    return True


def sync_cards(ctx: DayContext) -> bool:
    started = _now()
    raw, ok = _read(ctx, "cards")
    if not ok:
        return False
    with _fork(ctx) as hold:
        valid, errors = cards.transform(raw, ctx.day, ctx.run_ts, hold=hold)
        _quarantine(ctx, errors, "cards")
        staged = _stage(ctx, "cards", valid)
    _metrics(ctx, "cards", "cards", _merge_bucketed(ctx, "cards", staged), started)
    return True


def _fx_rates(ctx: DayContext) -> DataFrame:
    if ctx.fx_rates is not None:
        return ctx.fx_rates
    path = f"{ctx.base.rstrip('/')}/fx_rates"
    if path_exists(ctx.spark, path):
        return read(ctx.spark, path, "csv", S.FX_RATES_DDL)
    return ctx.spark.createDataFrame([], S.FX_RATES_DDL)


DUPLICATE_KEY = ("DUPLICATE_IDEMPOTENCY_KEY", "idempotency_key already used by another transaction")


def sync_transactions(ctx: DayContext) -> bool:
    started = _now()
    raw, ok = _read(ctx, "transactions")
    if not ok:
        return False
    merge_kw = dict(guard="updated_time", null_guard="accept_if_stored_null", staging_order=["updated_time desc_nulls_last"])
    state = ctx.store.read(STATE, S.PIPELINE_STATE_DDL, below=ctx.run)
    with _fork(ctx) as hold:
        seen_raw = Observation()
        records = unwrap(raw, "results").select("rec.*").observe(seen_raw, F.count(F.lit(1)).alias("rows"))
        valid, errors = transactions.transform(records, _fx_rates(ctx), ctx.day, ctx.run_ts, hold=hold)
        staged = _stage(ctx, "transactions", valid)
        if not seen_raw.get.get("rows", 0):  # A-15: no records -> nothing merged
            ctx.store.drop_partition("stg_transactions", STG_DAY, ctx.day)
            return False
        if ctx.delta_only:
            staged = since_watermark(staged, state, "transactions", "updated_time")
        good = staged
        if ctx.store.staged_buckets("transactions", ctx.run) is None:
            good, bad = split_clashes(staged, key_index(ctx.store))
            good = _stage(ctx, "transactions_unique", good)
            errors = errors.unionByName(
                to_quarantine(bad, "transactions", F.col("transaction_id"), F.col("raw_payload"), *DUPLICATE_KEY, ctx.day, ctx.run_ts)
            )
            _quarantine(ctx, errors, "transactions")
        else:  # a dead run has come this far: what it found still holds
            good = ctx.spark.read.schema(staged.schema).parquet(f"{ctx.store.path('stg_transactions_unique')}/{STG_DAY}={ctx.day}")
        counts = _merge_bucketed(ctx, "transactions", good, index=True, **merge_kw)
        ctx.store.write_version(STATE, advance_watermark(state, good, "transactions", "updated_time"), ctx.run)
    _metrics(ctx, "transactions", "transactions", counts, started)
    return True


def split_clashes(staged: DataFrame, index: KeyIndex) -> tuple[DataFrame, DataFrame]:
    """J-15: (rows to merge, rows whose key belongs to another row), within the batch and against the stored keys."""
    staged = drop_null_keys(staged, [index.owner])
    pair = [index.owner, index.key]
    folder = f"{index.store.path(CLASHES)}/{uuid.uuid4().hex}"

    def noted(name: str, rows: DataFrame) -> DataFrame:
        """The rows as a table: where they are few, the whole staged rows are not shuffled to be joined with them."""
        rows.write.parquet(f"{folder}/{name}")
        return staged.sparkSession.read.schema(rows.schema).parquet(f"{folder}/{name}")

    # keys and owners alone tell which keys clash; a key of one staged owner clashes with another stored one
    owner = F.col(index.owner)
    keys = staged.select(*pair).groupBy(index.key).agg(F.min(owner).alias("_least"), F.max(owner).alias("_greatest"))
    owners = index.owners(keys.select(index.key)).withColumnRenamed(index.owner, "_owner")
    many = keys.where(F.col(index.key).isNotNull() & (F.col("_least") != F.col("_greatest"))).select(index.key)
    taken = keys.join(owners, index.key).where(F.col("_owner") != F.col("_least")).select(index.key)
    clashing = noted("keys", many.unionByName(taken).distinct())
    bad = staged.join(clashing, index.key, "left_semi").dropDuplicates(pair)
    good = staged.join(noted("owners", bad.select(index.owner).distinct()), index.owner, "left_anti")
    return good, bad


def _day_date(day: str):
    """``'2024-05-01'`` -> that date; other day labels (``day1``) -> NULL."""
    try:
        return dt.date.fromisoformat(str(day).removeprefix("sync-"))
    except ValueError:
        return None


# ---------------------------------------------------------------------------
# flows
# ---------------------------------------------------------------------------
SKIPPED = "skipped"
STEPS: dict[str, Callable[[DayContext], bool]] = {
    "agents": sync_agents,
    "groups": sync_groups,
    "roles": sync_roles,
    "agent_roles": sync_agent_roles,
    "budgets": sync_budgets,
    "cards": sync_cards,
    "transactions": sync_transactions,
}


def run_step(ctx: DayContext, name: str) -> None:
    """One step, unless this run has committed it; its report is what the ledger holds."""
    if not ctx.store.committed(ctx.run, name):
        if not STEPS[name](ctx):
            ctx.results[name] = SKIPPED
        rows = {k: ctx.results.get(k, {}) for k in ("staged_rows", "quarantined_rows")}
        ctx.store.commit(ctx.run, name, {"result": ctx.results[name], **rows})
    report = ctx.store.report(ctx.run, name)
    ctx.results[name] = report["result"]
    for k in ("staged_rows", "quarantined_rows"):
        ctx.results[k] = {**report[k], **ctx.results.get(k, {})}


def run_day(
    spark: SparkSession,
    base: str,
    day: str,
    store: TableStore,
    fx_rates: DataFrame | None = None,
    run_ts: dt.datetime | None = None,
    run_id: str | None = None,
    direction: str = DESCENDANTS,
    delta_only: bool = False,
    mark_absent: bool = False,
    multiline: bool = True,
    rebalance: bool = False,
    only: Sequence[str] | None = None,
) -> dict:
    """M-01: sync every entity of one day (or the steps in ``only``); returns per-entity merge counts.

    An unfinished run of the day is taken up; a finished day is run again.
    """
    ctx = DayContext(
        spark, base, str(day), store, run_ts or _now(), run_id or str(uuid.uuid4()), fx_rates, direction, delta_only,
        mark_absent, multiline, rebalance,
    )
    ctx.day_date = _day_date(ctx.day) or ctx.run_ts.date()
    for name in STEPS:
        if only is None or name in only:
            run_step(ctx, name)
    finish(ctx)
    return ctx.results


def finish(ctx: DayContext) -> None:
    ctx.store.commit(ctx.run, "_finished", ctx.results)
    for table in ("stg_transactions", "stg_transactions_unique"):  # A-16
        ctx.store.drop_partition(table, STG_DAY, ctx.day)
    ctx.store.drop_table(CLASHES)
    ctx.store.drop_staged(ctx.run)


def backfill(spark: SparkSession, base: str, days, store: TableStore, restart: bool = False, run_ts=None, **kw) -> dict:
    """M-02: days in order; each day reads what the previous one wrote.

    ``restart`` skips days that a run has finished. ``run_ts``: the run time
    of all days, or a function of the day.
    """
    out = {}
    for d in map(str, days):
        done = store.finished_run(d) if restart else None
        out[d] = store.report(done, "_finished") if done is not None else run_day(spark, base, d, store, run_ts=run_ts(d) if callable(run_ts) else run_ts, **kw)
    return out
