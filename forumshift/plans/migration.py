"""The migration run: flows in the reference's order over immutable DataFrames.

``Migration`` holds the current state of every target table as a DataFrame.  Each flow
reads sources and the *current* target state and replaces the tables it writes -- the
statement snapshot of the reference comes for free because DataFrames are immutable.

Each statement is executed when its flow runs, like the reference's statements: the rows
a merge inserts are written as parquet to the shared ``spark.checkpoint.dir`` (never a
machine-local folder) and read back.  That cuts lineage -- a plan never grows with the
number of statements before it --, computes every id exactly once, and a lost executor
only recomputes the current statement.  Values that hold for the whole run are looked up by
one small job per step and enter later plans as literals.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import add_lineage, drop_lineage
from ..operators.keys import max_id_value
from ..operators.merge import append, insert_only_merge
from ..params import RunParams
from ..schemas import LINEAGE, SOURCES, TARGETS
from ..session import checkpoint_dir
from .crosswalk import with_lineage


class MigrationError(RuntimeError):
    pass


class Tables:
    """Target tables as ``base`` (as read) plus the parts a run added.

    Reading a table yields ``base UNION ALL part1 UNION ALL ...``: a shallow plan whatever
    the number of statements, because every part is a materialised leaf.  Appending never
    rewrites ``base`` -- on a real system that is the multi-terabyte message table.  An update of
    base rows is an overlay: the changed rows alone, which hide those of equal key.
    """

    def __init__(self, base: dict[str, DataFrame]):
        self.base = dict(base)
        self.base_at_start = dict(base)
        self.parts: dict[str, list[DataFrame]] = defaultdict(list)
        self.overlays: dict[str, tuple[str, DataFrame]] = {}

    def before_parts(self, name: str) -> DataFrame:
        """The base table as overlaid."""
        if name not in self.overlays:
            return self.base[name]
        key, rows = self.overlays[name]
        return self.base[name].join(rows.select(key), key, "left_anti").select(self.base[name].columns).unionByName(rows)

    def __getitem__(self, name: str) -> DataFrame:
        out = self.before_parts(name)
        for part in self.parts.get(name, []):
            out = out.unionByName(part)
        return out

    def __contains__(self, name: str) -> bool:
        return name in self.base

    def items(self):
        return [(n, self[n]) for n in self.base]


class Migration:
    def __init__(self, spark: SparkSession, sources: dict[str, DataFrame], targets: dict[str, DataFrame],
                 params: RunParams, materialize: bool = True, crosswalk: DataFrame | None = None):
        missing = [n for n in SOURCES if n not in sources]
        if missing:
            raise MigrationError(f"missing source tables: {missing}")
        for name in TARGETS:
            if name not in targets:
                raise MigrationError(f"missing target table: {name}")
        self.spark = spark
        self.src = sources
        self.p = params.resolved()
        # lineage columns exist for the duration of the run; a crosswalk says what they were before
        self.resumed = crosswalk is not None
        if crosswalk is not None:
            targets = {name: (with_lineage(drop_lineage(df, LINEAGE[name]), name, crosswalk, params.module_id)
                              if name in LINEAGE else df) for name, df in targets.items()}
        self.tgt = Tables({name: (add_lineage(df, LINEAGE[name]) if name in LINEAGE else df)
                           for name, df in targets.items()})
        self.scalars: dict = {}
        self.board_id: int | None = None
        self.new_rank: int | None = None
        self.done: list[str] = []
        self.timings: dict[str, float] = {}
        self._max_ids: dict[str, int] = {}
        self.inserted_by: dict[str, dict[str, list[DataFrame]]] = defaultdict(lambda: defaultdict(list))
        self.state_after: dict[str, dict[str, DataFrame]] = {}
        self._ctx = threading.local()
        self._lock = threading.Lock()
        self._user_map: DataFrame | None = None
        self.materialize = materialize
        self.run_id = uuid.uuid4().hex[:12]
        self._seq = 0
        self._root = checkpoint_dir(spark) if materialize else None
        self._content: DataFrame | None = None

    # ------------------------------------------------------------------ state
    def _store(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` as parquet under the shared checkpoint folder and read it back: the
        lineage is cut, ids are computed once, and later reads get column pruning, filter
        pushdown and real size statistics."""
        if not self.materialize:
            return df
        with self._lock:
            self._seq += 1
            seq = self._seq
        path = f"{self._root}/forumshift-{self.run_id}/{seq:03d}-{label}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def add_part(self, table: str, rows: DataFrame) -> DataFrame:
        stored = self._store(rows, table)
        self.tgt.parts[table].append(stored)
        self.inserted_by[self._ctx.current][table].append(stored)
        self._ctx.touched.add(table)
        return stored

    def update(self, table: str, fn: Callable[[DataFrame], DataFrame]) -> None:
        """Apply a row-preserving update to the rows this run inserted."""
        parts = self.tgt.parts.get(table) or []
        if not parts:
            return
        merged = parts[0]
        for p in parts[1:]:
            merged = merged.unionByName(p)
        self.tgt.parts[table] = [self._store(fn(merged), table)]
        self._ctx.touched.add(table)
        if table == "yaf_User":
            self._user_map = None

    def overlay(self, table: str, key: str, changed: DataFrame) -> DataFrame:
        """Let ``changed`` (whole rows with unique keys) stand for the base rows of their keys; returns
        them as staged.  What an earlier overlay says of other keys stays."""
        rows = self._store(changed.select(self.tgt.base[table].columns), f"{table}-overlay")
        if not rows.isEmpty():
            if table in self.tgt.overlays:
                old = self.tgt.overlays[table][1].join(rows.select(key), key, "left_anti").select(rows.columns)
                self.tgt.overlays[table] = (key, old.unionByName(rows))
            else:
                self.tgt.overlays[table] = (key, rows)
            self._ctx.touched.add(table)
            if table == "yaf_User":
                self._user_map = None
        return rows

    def state(self, fid: str, table: str) -> DataFrame:
        """``table`` as it was right after flow ``fid`` (flows must have run that far)."""
        if fid not in self.done:
            raise MigrationError(f"flow {fid} has not run")
        found = self.tgt.base_at_start[table]
        for f, _ in flows():
            if table in self.state_after.get(f, {}):
                found = self.state_after[f][table]
            if f == fid:
                break
        return found

    def inserted_in(self, table: str, *fids: str) -> DataFrame:
        """Rows flows ``fids`` inserted into ``table``, as inserted (before later updates)."""
        parts = [p for f in fids for p in self.inserted_by.get(f, {}).get(table, [])]
        if not parts:
            return self.tgt.base_at_start[table].limit(0)
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # ------------------------------------------------------------------ helpers
    def merge(self, table: str, source: DataFrame, keys: Sequence[str], *, source_keys: Sequence[str] | None = None,
              scope: Column | None = None, id_col: str | None = None, id_order: Sequence | None = None,
              attach: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """D1 into ``table``; returns the inserted rows (materialised).  String keys compare under
        the run's name collation.  ``attach`` joins payload columns to the numbered rows."""
        res = insert_only_merge(self.tgt[table], source, keys, source_keys=source_keys, target_filter=scope,
                                id_col=id_col, id_order=id_order, id_partitions=self.p.id_partitions,
                                collation=self.p.name_collation, stage=self._stage_fn(table),
                                base_id=self._max_id(table, id_col), attach=attach)
        self._advance(table, id_col, res.numbered)
        if table == "yaf_User":
            self._user_map = None
        return self.add_part(table, res.inserted)

    def append(self, table: str, source: DataFrame, id_col: str | None = None, id_order: Sequence | None = None):
        res = append(self.tgt[table], source, id_col=id_col, id_order=id_order, id_partitions=self.p.id_partitions,
                     stage=self._stage_fn(table), base_id=self._max_id(table, id_col))
        self._advance(table, id_col, res.numbered)
        return self.add_part(table, res.inserted)

    def _max_id(self, table: str, id_col: str | None) -> int | None:
        """Highest id of ``table``: read once from the base table, then advanced by the
        number of rows each statement numbered (ids are dense), so no statement rescans it."""
        if id_col is None:
            return None
        if table not in self._max_ids:
            self._max_ids[table] = max_id_value(self.tgt[table], id_col)
        return self._max_ids[table]

    def _advance(self, table: str, id_col: str | None, numbered: int | None) -> None:
        if id_col is not None and numbered is not None:
            self._max_ids[table] = self._max_ids[table] + numbered

    def _stage_fn(self, table: str):
        if not self.materialize:
            return None
        return lambda df: self._store(df, f"{table}-keys")

    def absent(self, source: DataFrame, key: str, table: str) -> DataFrame:
        """In a resumed run, the source rows that the crosswalk does not have; else all of them."""
        if not self.resumed:
            return source
        done = self.tgt.base[table].select(F.col(LINEAGE[table]).alias(key)).filter(F.col(key).isNotNull())
        return source.join(done, key, "left_anti")

    def board_rows(self, table: str) -> DataFrame:
        return self.tgt[table].filter(F.col("BoardID") == F.lit(self.board_id))

    def user_map(self) -> DataFrame:
        """Portal user id -> user of the new board, by name (J2).  Built once per state of
        yaf_User and stored, then reused by every content flow instead of repeating
        ``Users JOIN yaf_User ON UserName = Name``."""
        if self._user_map is None:
            from .users import build_user_map
            self._user_map = self._store(build_user_map(self), "user_map")
        return self._user_map

    def content_rows(self) -> DataFrame:
        """The narrow columns of every content row, staged once: three statements look authors,
        dates and flags up here and touch the texts only to attach them."""
        if self._content is None:
            self._content = self._store(self.src["af_content"].select(
                "ContentID", "AuthorID", "DateCreated", "IPAddress", "IsDeleted"), "content")
        return self._content

    def drop_staged(self) -> None:
        """Remove this run's staged folder, once its results are written elsewhere."""
        if self._root:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._root}/forumshift-{self.run_id}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    # ------------------------------------------------------------------ running
    def _exec(self, fid: str, fn: Callable[["Migration"], None]) -> None:
        t0 = time.perf_counter()
        self._ctx.current, self._ctx.touched = fid, set()
        fn(self)
        self.state_after[fid] = {t: self.tgt[t] for t in self._ctx.touched}
        self.timings[fid] = round(time.perf_counter() - t0, 3)
        with self._lock:
            self.done.append(fid)

    def run(self, upto: str | None = None, parallel: bool = False) -> "Migration":
        """Run the flows in order up to ``upto`` (inclusive).

        ``parallel``: after the board exists, three groups of statements touch disjoint
        tables and read nothing the others write (SURVEY 3): the template lookups, the
        group/user chain and the forum tree.  They are submitted from three threads --
        Spark runs jobs of one session concurrently -- and joined before the content flows.
        Results are identical to the sequential order.
        """
        order = flows()
        ids = [f for f, _ in order]
        lane_flows = {f for lane in PARALLEL_LANES for f in lane}
        after_lanes = upto is None or ids.index(upto) >= max(ids.index(f) for f in lane_flows)
        if parallel and after_lanes:
            fns = dict(order)
            for fid in ("F01", "F02"):
                if fid not in self.done:
                    self._exec(fid, fns[fid])
            lanes = [[f for f in lane if f not in self.done] for lane in PARALLEL_LANES]
            errors: list[BaseException] = []

            def work(lane: list[str]) -> None:
                try:
                    for f in lane:
                        self._exec(f, fns[f])
                except BaseException as e:  # surfaced below, after all lanes stop
                    errors.append(e)
            threads = [threading.Thread(target=work, args=(lane,)) for lane in lanes if lane]
            for t in threads:
                t.start()
            for t in threads:
                t.join()
            if errors:
                raise errors[0]
        for fid, fn in order:
            if fid in self.done:
                if fid == upto:
                    break
                continue
            self._exec(fid, fn)
            if fid == upto:
                break
        return self

    def published(self) -> dict[str, DataFrame]:
        """target tables as they are published (lineage columns dropped)."""
        return {name: (drop_lineage(df, LINEAGE[name]) if name in LINEAGE else df) for name, df in self.tgt.items()}

    def changes(self) -> tuple[dict[str, DataFrame], list[str]]:
        """What a publish has to write, lineage dropped: the rows added to each table, or the whole
        table where a statement changed old rows; and the names of the tables that are whole."""
        if len(self.done) < len(flows()):
            left = [f for f, _ in flows() if f not in self.done]
            raise MigrationError(f"a partial run is not published; flows left: {left}")
        rewritten = [n for n in self.tgt.base if n in self.tgt.overlays]
        out = {}
        for name in self.tgt.base:
            if name in rewritten or self.tgt.parts.get(name):
                df = self.tgt[name] if name in rewritten else self.inserted_rows(name)
                out[name] = drop_lineage(df, LINEAGE[name]) if name in LINEAGE else df
        return out, rewritten

    def inserted_rows(self, table: str) -> DataFrame:
        parts = self.tgt.parts.get(table) or []
        if not parts:
            return self.tgt.base[table].limit(0)
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


# Statement groups with disjoint target tables and no reads of each other's output.
PARALLEL_LANES = (
    ("F03", "F07", "F08", "F09", "F10", "F11", "F12", "F13"),
    ("F04", "F05", "F06", "F14", "F15", "F16", "F17", "F18", "F19", "F20", "F21", "F22", "F23", "F24"),
    ("F25", "F26", "F27"),
)


def flows() -> list[tuple[str, Callable[[Migration], None]]]:
    from . import board, content, forums, resync, subscriptions, users
    return [
        ("F01", board.resolve_run_scalars),
        ("F02", board.create_board),
        ("F03", board.clone_access_masks),
        ("F04", board.clone_default_groups),
        ("F05", board.groups_from_roles),
        ("F06", board.clone_ranks),
        ("F07", board.clone_smileys),
        ("F08", board.clone_spam_words),
        ("F09", board.clone_replace_words),
        ("F10", board.clone_extensions),
        ("F11", board.clone_bbcodes),
        ("F12", board.clone_topic_status),
        ("F13", board.clone_registry),
        ("F14", board.aspnet_roles),
        ("F15", users.clone_guest),
        ("F16", users.create_users),
        ("F17", users.user_profiles),
        ("F18", users.guest_membership),
        ("F19", users.registered_membership),
        ("F20", users.superuser_membership),
        ("F21", users.role_memberships),
        ("F22", users.raise_admin_flags),
        ("F23", users.raise_superuser_flags),
        ("F24", users.aspnet_user_roles),
        ("F25", forums.categories),
        ("F26", forums.parent_forums),
        ("F27", forums.child_forums),
        ("F28", content.topics),
        ("F29", content.first_posts),
        ("F30", content.replies),
        ("F31", content.attachments),
        ("F32", content.topic_statistics),
        ("F33", subscriptions.watch_forums),
        ("F34", subscriptions.watch_topics),
        ("F35", subscriptions.forum_access),
        ("F36", resync.forum_rollup),
    ]
