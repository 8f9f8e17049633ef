"""Stateful stream operators: what they keep per key is a few fixed-size values.

They stand before the watermark (no time mode, so no late-row filter): a late row is flagged or
retracted like any other, and only a window that is closed already drops it. State is kept for
ever unless `ttl_ms` names the processing time after which an unused value may go; a row that
comes later than that is treated as the first of its key.
"""
from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAY_MS = 86_400_000


def _day(ms):
    return (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=ms)).strftime("%Y-%m-%d")


class FirstOfDay(StatefulProcessor):
    """Flags the earliest row of a key on a day not seen before.

    Rows pass through as they come; only the best candidate per day is held back
    until the end of the batch. Where a candidate column is named, rows without that
    flag cannot be first.
    """

    def __init__(self, ts, columns, flag, candidate=None, ttl_ms=None):
        self.ts, self.columns, self.flag, self.candidate, self.ttl_ms = ts, columns, flag, candidate, ttl_ms

    def init(self, handle: StatefulProcessorHandle):
        self.days = handle.getMapState("days", "day bigint", "seen boolean", self.ttl_ms)
        self.row = T.Row(*self.columns, self.flag)

    def _out(self, row, flag):
        return self.row(*[row[c] for c in self.columns], flag)

    def handleInputRows(self, key, rows, timerValues):
        best = {}
        for row in rows:
            if self.candidate and not row[self.candidate]:
                yield self._out(row, 0)
                continue
            day = row[self.ts] // DAY_MS
            held = best.get(day)
            if held is None:
                if self.days.containsKey((day,)):
                    yield self._out(row, 0)
                else:
                    best[day] = row
            elif row[self.ts] < held[self.ts]:
                best[day] = row
                yield self._out(held, 0)
            else:
                yield self._out(row, 0)
        for day, row in best.items():
            self.days.updateValue((day,), (True,))
            yield self._out(row, 1)

    def close(self):
        pass


class FixIsNew(StatefulProcessor):
    """Keeps the day on which a visitor's "new" marks stand, set by the first record.

    Once the day is known rows pass straight through, as dirty rows always do. In the
    batch that shows a visitor for the first time, rows that claim to be new wait
    in memory for its end: limit the source's rate where one visitor may send very many.
    """

    def __init__(self, columns, ttl_ms=None):
        self.columns, self.ttl_ms = columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle):
        self.base = handle.getValueState("base", "day bigint", self.ttl_ms)
        self.row = T.Row(*self.columns)

    def _out(self, row, mark):
        return self.row(*[mark if c == "_mark" else row[c] for c in self.columns])

    def _fixed(self, row, base):
        return "1" if row["ts"] // DAY_MS == base else "0"

    def handleInputRows(self, key, rows, timerValues):
        known = self.base.get()
        if known is not None:
            for row in rows:
                new = row["_mark"] == "1" and not row["_dirty"]
                yield self._out(row, self._fixed(row, known[0]) if new else row["_mark"])
            return
        first, waiting = None, []
        for row in rows:
            if row["_dirty"]:
                yield self._out(row, row["_mark"])
                continue
            new = row["_mark"] == "1"
            rank = (row["ts"], 0 if new else 1)
            if first is None or rank < first:
                first = rank
            if new:
                waiting.append(row)
            else:
                yield self._out(row, row["_mark"])
        if first is None:
            return
        base = first[0] // DAY_MS - first[1]
        self.base.update((base,))
        for row in waiting:
            yield self._out(row, self._fixed(row, base))

    def close(self):
        pass


class Retract(StatefulProcessor):
    """Keeps the newest version of a key and negates whatever it replaces.

    Works in any order of arrival: a row newer than the kept one cancels that one,
    an older row is emitted and cancelled at once.
    """

    def __init__(self, columns, order, amounts, stored, ttl_ms=None):
        self.columns, self.order, self.amounts, self.stored, self.ttl_ms = columns, order, amounts, stored, ttl_ms

    def init(self, handle: StatefulProcessorHandle):
        self.last = handle.getValueState("last", self.stored, self.ttl_ms)
        self.row = T.Row(*self.columns)

    def _negated(self, values):
        return self.row(*[-v if c in self.amounts and v is not None else v
                       for c, v in zip(self.columns, values)])

    def handleInputRows(self, key, rows, timerValues):
        at = [self.columns.index(c) for c in self.order]
        kept = self.last.get()
        for row in rows:
            values = tuple(row[c] for c in self.columns)
            yield self.row(*values)
            if kept is None:
                kept = values
            elif [values[i] for i in at] > [kept[i] for i in at]:
                yield self._negated(kept)
                kept = values
            else:
                yield self._negated(values)
        self.last.update(kept)

    def close(self):
        pass


def _stateful(df, keys, processor, schema, ttl_ms):
    return df.groupBy(*keys).transformWithState(processor, schema, "Append", "ProcessingTime" if ttl_ms else "None")


def _flag_first(df, keys, ts, flag, candidate, ttl_ms):
    schema = T.StructType([*df.schema.fields, T.StructField(flag, T.LongType())])
    return _stateful(df, keys, FirstOfDay(ts, df.columns, flag, candidate, ttl_ms), schema, ttl_ms)


def first_of_day_stream(df, keys, ts, flag, slices=1, candidate=None, ttl_ms=None):
    if slices == 1:
        return _flag_first(df, keys, ts, flag, candidate, ttl_ms)
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(ts), F.lit(slices)))
    local = _flag_first(sliced, [*keys, "_slice"], ts, "_local", candidate, ttl_ms)
    # Rows that lost within their slice stay spread; the winners meet under one key.
    spread = local.withColumn("_slice", F.when(F.col("_local") == 0, F.col("_slice")))
    return _flag_first(spread, [*keys, "_slice"], ts, flag, "_local", ttl_ms).drop("_slice", "_local")


def fix_is_new_stream(logs, ttl_ms=None):
    from brookmart.operators.logs import with_is_new
    dirty = F.col("_dirty") if "_dirty" in logs.columns else F.lit(False)
    flat = logs.withColumn("_dirty", dirty).withColumn("_mark", F.col("common")["is_new"])
    # Dirty rows take part in no visitor's state; they are spread by what they say.
    own = F.concat(F.lit("\0"), F.pmod(F.xxhash64("value"), F.lit(1024)).cast("string")) if "value" in logs.columns else F.lit("\0")
    flat = flat.withColumn("_visitor", F.when(F.col("_dirty"), own).otherwise(F.col("common")["mid"]))
    fixed = _stateful(flat, ["_visitor"], FixIsNew(flat.columns, ttl_ms), flat.schema, ttl_ms)
    return fixed.withColumn("common", with_is_new(F.col("common"), F.col("_mark"))).select(*logs.columns)


def retract_stream(df, key, order, amounts, ttl_ms=None):
    stored = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    return _stateful(df, [key], Retract(df.columns, order, list(amounts), stored, ttl_ms), df.schema, ttl_ms)
