"""Gap sessionisation of clicks: one shuffle by client and time, a streaming state machine, and a second fold where ranges meet."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyrelith.runtime import Scratch

MINUTE = 60_000_000
#: What a folded row is: a session; a click beside a range's border, before or after it; the click that ends the piece before the border; a range's own line.
SESSION, BEFORE, AFTER, STOP, RANGE = range(5)
#: Columns that a fold reads, in this order; ``late`` counts the late clicks that a row stands for, 0 in a timely one.
CLICK = ("client_id", "ts", "late", "click_id", "final", "cents")
SESSION_COLS = ("client_id", "session_id", "start_us", "end_us", "n_clicks", "n_late", "value_cents", "closed_by", "path_sha256")


def microseconds(c: Column, kind: T.DataType) -> Column:
    """Microseconds since 1970: of the instant, or of the time on the clock where a timestamp has no zone."""
    return F.unix_micros(F.from_utc_timestamp(c.cast("timestamp"), F.current_timezone()) if isinstance(kind, T.TimestampNTZType) else c)


def clicks_once(clicks: DataFrame, late_us: int, final_kind: str, final_value: float) -> DataFrame:
    """``CLICK`` rows with client and time, once for each click_id: of rows that repeat it the one that arrived first, then the smallest."""
    us = {c: microseconds(F.col(c), clicks.schema[c].dataType) for c in ("ts", "arrived_at")}
    cents = F.when(F.isnan("value") | (F.abs("value") == float("inf")), 0).otherwise(F.coalesce(F.floor(100 * F.col("value") + 0.5), F.lit(0)))
    rows = clicks.where("client_id is not null and ts is not null").select(
        "click_id",
        F.struct(us["arrived_at"].alias("arrived"), us["ts"].alias("ts"), "client_id", F.coalesce((F.col("kind") == final_kind) & (F.col("value") >= final_value), F.lit(False)).alias("final"), cents.cast("long").alias("cents")).alias("r"),
    )
    rows = rows.groupBy("click_id").agg(F.min("r").alias("r"))
    late = F.coalesce(F.col("r.arrived") - F.col("r.ts") > late_us, F.lit(False)).cast("long")
    return rows.select("r.client_id", "r.ts", late.alias("late"), "click_id", "r.final", "r.cents")


class Machine:
    """The state of one client's open session: when it began, the last click, what has come so far."""

    def __init__(self, gap_us: int, length_us: int):
        self.gap, self.length = gap_us, length_us
        self.start = self.last = None
        self.final = False
        self.clicks: list[tuple] = []  # of the open session: (ts, late, click_id, final, cents), runs of late clicks as one

    def reason(self, ts: int) -> str | None:
        """Why a timely click can't go on with the open session."""
        if self.final:
            return "end"
        if ts - self.last >= self.gap:
            return "gap"
        return "length" if ts - self.start > self.length else None

    def begin(self, ts: int, click: tuple) -> None:
        self.start, self.clicks = ts, []
        self.go_on(ts, click)

    def go_on(self, ts: int, click: tuple) -> None:
        self.last, self.final = ts, click[3]
        self.clicks.append(click)

    def count_late(self, ts: int, n: int) -> None:
        if self.clicks[-1][1]:
            n += self.clicks.pop()[1]
        self.clicks.append((ts, n, None, False, 0))

    def close(self, client, reason: str) -> tuple:
        timely = [c for c in self.clicks if not c[1]]
        path = hashlib.sha256(",".join("" if c[2] is None else str(c[2]) for c in timely).encode()).hexdigest()
        out = (client, timely[0][2], self.start, self.last, len(timely), sum(c[1] for c in self.clicks), sum(c[4] for c in timely), reason, path)
        self.start, self.clicks = None, []
        return out


def fold_schema(clicks: DataFrame, grouped: bool) -> T.StructType:
    kinds = {f.name: f.dataType for f in clicks.schema.fields}
    long, text = T.LongType(), T.StringType()
    cols = [("client_id", kinds["client_id"]), ("session_id", kinds["click_id"])]
    cols += [(c, text if c in ("closed_by", "path_sha256") else long) for c in SESSION_COLS[2:]]
    if not grouped:
        cols = [("what", long), ("range", long), *cols, ("ts", long), ("late", long), ("click_id", kinds["click_id"]), ("final", T.BooleanType()), ("cents", long)]
    return T.StructType([T.StructField(n, k) for n, k in cols])


def arrow_rows(rows: list[tuple], schema: T.StructType):
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    cols = zip(*rows, strict=True) if rows else [[] for _ in schema]
    want = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, want, strict=True)], names=want.names)


def clicks_of(batch, names: tuple[str, ...]) -> Iterator[tuple]:
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def fold_ranges(schema: T.StructType, gap_us: int, length_us: int):
    """Folds one range of all clicks, sorted by client and time; its first clicks may belong to a session begun before it.

    Whatever happened before, a click after a gap or after a final click begins a session. So of the range's
    first client only the clicks before the first of these stay clicks (``BEFORE``), and so does the last
    client's open session (``AFTER``). All other sessions are whole. Kept in memory is the open session.
    """
    none = (None,) * len(SESSION_COLS)
    nothing = (None,) * 5

    def fold(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId()
        m, client, seen, head, waiting, rows = Machine(gap_us, length_us), None, False, True, 0, []

        def click(what, ts, late, click_id, final, cents):
            return (what, at, client, *none[1:], ts, late, click_id, final, cents)

        for batch in batches:
            for who, ts, late, click_id, final, cents in clicks_of(batch, CLICK):
                if who != client or not seen:
                    if head and waiting:
                        rows.append(click(BEFORE, when, waiting, None, False, 0))  # noqa: F821 - set with waiting
                    elif m.start is not None:
                        rows.append((SESSION, at, *m.close(client, "end" if m.final else "none"), *nothing))
                    head, waiting, client, seen = not seen, 0, who, True
                    m.last, m.final = None, False
                if late:
                    if head:
                        waiting, when = waiting + late, ts
                    elif m.start is not None:
                        m.count_late(ts, late)
                    continue
                this = (ts, 0, click_id, final, cents)
                if head:
                    if waiting:
                        rows.append(click(BEFORE, when, waiting, None, False, 0))
                        waiting = 0
                    if m.last is not None and (m.final or ts - m.last >= gap_us):
                        rows.append(click(STOP, *this))
                        head = False
                        m.begin(ts, this)
                    else:
                        rows.append(click(BEFORE, *this))
                        m.last, m.final = ts, final
                elif m.start is None:
                    m.begin(ts, this)
                elif why := m.reason(ts):
                    rows.append((SESSION, at, *m.close(client, why), *nothing))
                    m.begin(ts, this)
                else:
                    m.go_on(ts, this)
            if len(rows) > 20_000:
                yield arrow_rows(rows, schema)
                rows = []
        if head and waiting:
            rows.append(click(BEFORE, when, waiting, None, False, 0))
        rows += [click(AFTER, *c) for c in m.clicks]
        if seen:
            rows.append((RANGE, at, *none, None, int(head), None, None, None))
        if rows:
            yield arrow_rows(rows, schema)

    return fold


def fold_borders(schema: T.StructType, gap_us: int, length_us: int):
    """Folds the clicks beside borders, sorted by border, client and time: each client of a border from its first click on."""

    def fold(batches: Iterator) -> Iterator:
        m, group, rows = Machine(gap_us, length_us), None, []
        for batch in batches:
            for border, what, who, ts, late, click_id, final, cents in clicks_of(batch, ("border", "what", *CLICK)):
                if (border, who) != group:
                    if m.start is not None:
                        rows.append(m.close(group[1], "end" if m.final else "none"))
                    group = (border, who)
                if late:
                    if m.start is not None:
                        m.count_late(ts, late)
                    continue
                this = (ts, 0, click_id, final, cents)
                why = m.reason(ts) if m.start is not None else None
                if why:
                    rows.append(m.close(who, why))
                if what == STOP:
                    continue
                if m.start is None:
                    m.begin(ts, this)
                else:
                    m.go_on(ts, this)
            if len(rows) > 20_000:
                yield arrow_rows(rows, schema)
                rows = []
        if m.start is not None:
            rows.append(m.close(group[1], "end" if m.final else "none"))
        if rows:
            yield arrow_rows(rows, schema)

    return fold


def by_session(scratch: Scratch, beside: DataFrame, joined: DataFrame, gap_us: int, length_us: int) -> DataFrame:
    """The clicks beside borders with a ``border`` of one text; where a range joins its two borders, each session gets one of its own.

    Such a border may hold very many clicks of one client, with no sure beginning of a session between the ends of a range. So
    its sessions' beginnings are found first, then every session is folded alone. Only where two ranges meet may a gap or a
    final click part the clicks; between such places a session begins with the first click more than ``length_us`` after the one before began.
    """
    joined = scratch.table(joined, "joined")
    if joined.isEmpty():
        return beside.withColumn("border", F.col("border").cast("string")).drop("range")
    alone = beside.join(joined, "border", "left_anti").withColumn("border", F.col("border").cast("string")).drop("range")
    rows = scratch.table(beside.join(joined, "border", "left_semi").withColumn("block", F.floor(F.col("ts") / length_us)), "joined-rows")
    timely = rows.where((F.col("late") == 0) & (F.col("what") != STOP))
    who = ["border", "client_id"]
    # the parts between which a session surely ends: one row a range
    ends = timely.groupBy(*who, "range").agg(F.min("ts").alias("first"), F.max(F.struct("ts", "click_id", "final")).alias("last"))
    before = Window.partitionBy(*who).orderBy("range")
    parted = F.lag("last.final").over(before) | (F.col("first") - F.lag("last.ts").over(before) >= gap_us)
    parts = ends.withColumn("parted", F.coalesce(parted, F.lit(False)).cast("long")).withColumn("part", F.sum("parted").over(before))
    timely = scratch.table(timely.join(parts.select(*who, "range", "part"), [*who, "range"]), "joined-timely")
    group = [*who, "part"]
    starts = scratch.table(beginnings(scratch, timely.select(*group, "ts", "block").distinct(), group, length_us), "starts")
    order = Window.partitionBy(*who).orderBy("start", "part")
    starts = starts.withColumn("block", F.floor(F.col("start") / length_us)).withColumn("earlier", F.lag(F.struct("start", "part")).over(order))
    name = lambda part, start: F.concat_ws(":", "border", part.cast("string"), start.cast("string")).alias("border")
    here = timely.join(known_in(starts, group, 1), [*group, "block"]).withColumn("s", F.array_max(F.filter("known", lambda k: k["start"] <= F.col("ts"))))
    here = here.select(name(F.col("s.part"), F.col("s.start")), "what", *CLICK)
    # late clicks and the one that ends the border's last session belong to what began last
    rest = rows.where((F.col("late") > 0) | (F.col("what") == STOP)).join(known_in(starts, who, 1 + -(-gap_us // length_us)), [*who, "block"])
    rest = rest.withColumn("s", F.array_max(F.filter("known", lambda k: k["start"] <= F.col("ts")))).where("s is not null").select(name(F.col("s.part"), F.col("s.start")), "what", *CLICK)
    first = timely.join(starts.where("earlier is not null").select(*group, F.col("start").alias("ts"), "earlier"), [*group, "ts"])
    first = first.groupBy(*who, "earlier", "ts").agg(F.min(F.struct("click_id", "late", "final", "cents")).alias("c"))
    stops = first.select(name(F.col("earlier.part"), F.col("earlier.start")), F.lit(STOP).cast("long").alias("what"), "client_id", "ts", "c.late", "c.click_id", "c.final", "c.cents")
    return alone.unionByName(here).unionByName(rest).unionByName(stops)


def known_in(starts: DataFrame, by: list[str], blocks: int) -> DataFrame:
    """For each block of time the sessions that began in it or up to ``blocks`` before: one a block, but where ranges part them."""
    s = starts.select(*by, F.explode(F.sequence(F.col("block"), F.col("block") + blocks)).alias("block"), F.struct("start", "part").alias("k"))
    return s.groupBy(*by, "block").agg(F.collect_list("k").alias("known"))


def beginnings(scratch: Scratch, points: DataFrame, group: list[str], length_us: int) -> DataFrame:
    """``(*group, start)``: the first time of each group, and from each start the first time more than ``length_us`` after it.

    Every time knows its successor: the next one after it and ``length_us``, in that block of time or the one after, as no gap is
    as long as a block. Doubling the successors, 1, 2, 4, ... sessions on, reaches all starts in as many joins as their number has digits.
    """
    points = scratch.table(points, "points")
    block = Window.partitionBy(*group, "block").orderBy(F.desc("t"), F.desc("probe")).rowsBetween(Window.unboundedPreceding, -1)
    probes = points.select(*group, (F.col("ts") + length_us).alias("t"), (F.col("block") + 1).alias("block"), F.lit(1).alias("probe"))
    both = points.select(*group, F.col("ts").alias("t"), "block", F.lit(0).alias("probe")).unionByName(probes)
    found = both.withColumn("next", F.last(F.when(F.col("probe") == 0, F.col("t")), ignorenulls=True).over(block)).where("probe = 1")
    lowest = points.groupBy(*group, (F.col("block") - 1).alias("block")).agg(F.min("ts").alias("after"))
    jumps = found.join(lowest, [*group, "block"], "left").select(*group, (F.col("t") - length_us).alias("ts"), F.coalesce("next", "after").alias("to")).where("to is not null")
    jumps = scratch.table(jumps, "jumps0")
    starts, k = scratch.table(points.groupBy(*group).agg(F.min("ts").alias("start")), "starts0"), 0
    while True:
        more = scratch.table(starts.join(jumps.withColumnRenamed("ts", "start"), [*group, "start"]).select(*group, F.col("to").alias("start")), f"more{k}")
        if more.isEmpty():
            return starts
        k += 1
        starts = scratch.table(starts.unionByName(more).distinct(), f"starts{k}")
        again = jumps.select(*group, F.col("ts").alias("to"), F.col("to").alias("on"))
        jumps = scratch.table(jumps.join(again, [*group, "to"]).select(*group, "ts", F.col("on").alias("to")), f"jumps{k}")


def sessions(clicks: DataFrame, gap_min: int = 30, length_min: int = 120, late_min: int = 60, final_kind: str = "purchase", final_value: float = 60) -> DataFrame:
    """One row a session: ``SESSION_COLS``.

    Clicks are dealt to ranges of (client, time), so that a client with a third of all clicks lies in as many
    ranges as its clicks need, and are sorted within them. Each range is streamed once through a state
    machine that makes its whole sessions; the few clicks at its two ends, whose session may lie across the
    border, stay clicks. They are dealt by border, one border's clicks together, and folded again; a range
    in which no click surely begins a session joins its two borders to one, and then the beginnings of that border's sessions are found by
    joins and its clicks are dealt by session. Late clicks are counted where they stand, runs of them as one row. So no task gets more
    of a client than a range, or what two hours of it hold (``length_min``).

    Rows without client or time are left out. A null click_id counts as one id, empty in the path. Of rows that
    repeat a click_id the one that arrived first counts (null first). A null arrival is timely, a null or
    non-finite value 0 cents, a null kind never final. Clicks of one time follow each other by click_id,
    and late ones come after timely ones of their time. Late clicks before a client's first session join
    none. An empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(clicks.sparkSession, "sessions")
    once = clicks_once(clicks, late_min * MINUTE, final_kind, final_value)
    order = ["client_id", "ts", "late", "click_id"]
    times = (gap_min * MINUTE, length_min * MINUTE)
    ranged = once.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = fold_schema(once, False)
    folded = scratch.table(ranged.select(*CLICK).mapInArrow(fold_ranges(schema, *times), schema), "folded")
    # a border's number grows after each range that surely begins a session; one row a range
    before = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ranges = folded.where(F.col("what") == RANGE).select(F.col("range").alias("at"), (1 - F.col("late")).alias("begins"))
    ranges = ranges.withColumn("border", F.coalesce(F.sum("begins").over(before), F.lit(0)))
    beside = folded.where(F.col("what").isin(BEFORE, AFTER, STOP)).join(ranges, F.col("range") == F.col("at"))
    beside = beside.select((F.col("border") + (F.col("what") == AFTER).cast("long")).alias("border"), "range", "what", *CLICK)
    beside = by_session(scratch, beside, ranges.where("begins = 0").select("border").distinct(), *times)
    beside = beside.repartition("border").sortWithinPartitions("border", "client_id", "ts", F.col("late") > 0, "click_id")
    schema = fold_schema(once, True)
    return folded.where(F.col("what") == SESSION).select(*SESSION_COLS).unionByName(beside.mapInArrow(fold_borders(schema, *times), schema))


ORACLE = r"""
WITH RECURSIVE once AS (SELECT DISTINCT ON (click_id) click_id, client_id, epoch_us(ts) AS ts, coalesce(epoch_us(arrived_at) - epoch_us(ts) > 3600000000, false) AS late, coalesce(kind = 'purchase' AND value >= 60, false) AS final, CAST(coalesce(floor(100 * value + 0.5), 0) AS BIGINT) AS cents FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL ORDER BY click_id, arrived_at),
prev AS (SELECT *, lag(ts) OVER w AS p_ts, coalesce(lag(final) OVER w, false) AS p_final FROM once WHERE NOT late WINDOW w AS (PARTITION BY client_id ORDER BY ts, click_id)),
chain AS (SELECT *, sum(CASE WHEN p_ts IS NULL OR p_final OR ts - p_ts >= 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY client_id ORDER BY ts, click_id ROWS UNBOUNDED PRECEDING) AS chain FROM prev),
long AS (SELECT client_id, chain, min(ts) AS ts FROM chain GROUP BY 1, 2),
starts AS (SELECT client_id, chain, ts AS start_us FROM long UNION ALL SELECT c.client_id, c.chain, min(c.ts) FROM starts s JOIN chain c ON c.client_id = s.client_id AND c.chain = s.chain AND c.ts > s.start_us + 7200000000 GROUP BY c.client_id, c.chain, s.start_us),
placed AS (SELECT c.*, s.start_us FROM chain c ASOF JOIN starts s ON c.client_id = s.client_id AND c.chain = s.chain AND c.ts >= s.start_us),
grouped AS (SELECT client_id, chain, start_us, min_by(click_id, (ts, click_id)) AS session_id, max(ts) AS end_us, count(*) AS n_clicks, CAST(sum(cents) AS BIGINT) AS value_cents, max_by(final, (ts, click_id)) AS last_final, sha256(string_agg(CAST(click_id AS VARCHAR), ',' ORDER BY ts, click_id)) AS path_sha256 FROM placed GROUP BY 1, 2, 3),
nexts AS (SELECT *, lead(start_us) OVER (PARTITION BY client_id ORDER BY start_us, session_id, end_us) AS next_us FROM grouped),
lates AS (SELECT n.client_id, n.chain, n.start_us, count(*) AS n_late FROM once o JOIN nexts n ON o.late AND o.client_id = n.client_id AND o.ts >= n.start_us AND (n.next_us IS NULL OR o.ts < n.next_us) GROUP BY 1, 2, 3)
SELECT client_id, session_id, start_us, end_us, n_clicks, coalesce(n_late, 0) AS n_late, value_cents, CASE WHEN last_final THEN 'end' WHEN next_us IS NULL THEN 'none' WHEN next_us - end_us >= 1800000000 THEN 'gap' ELSE 'length' END AS closed_by, path_sha256 FROM nexts LEFT JOIN lates USING (client_id, chain, start_us)
"""
