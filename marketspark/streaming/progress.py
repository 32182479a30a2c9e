"""Counters from streaming progress: rows taken, rows dropped as late, state size, and messages by stage and reason."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from marketspark.operators.silver import CONTRACT_BROKEN, RULE_BROKEN, UNKNOWN_VERSION, UNREADABLE

OBSERVED = "stages"
REASONS = (UNREADABLE, UNKNOWN_VERSION, CONTRACT_BROKEN, RULE_BROKEN)


class ProgressCounters(StreamingQueryListener):
    """Running totals per query name; ``snapshot()`` may be called from any thread."""

    def __init__(self) -> None:
        super().__init__()
        self._lock = threading.Lock()
        self._totals: dict[str, dict[str, int]] = defaultdict(
            lambda: {"batches": 0, "input_rows": 0, "late_rows": 0, "state_rows": 0}
        )

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            totals = self._totals[progress.name or str(progress.id)]
            totals["batches"] += 1
            totals["input_rows"] += progress.numInputRows
            totals["late_rows"] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
            totals["state_rows"] = sum(op.numRowsTotal for op in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def snapshot(self) -> dict[str, dict[str, int]]:
        with self._lock:
            return {name: dict(totals) for name, totals in self._totals.items()}


def late_rows(query) -> int:
    """Late rows dropped so far in the retained progress of a query."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def observe_stages(decoded: DataFrame) -> DataFrame:
    """``decoded`` messages, with counts of stages and reasons observed as the rows go by; no second scan.

    Each micro-batch reports raw, bronze, silver and dead-letter counts, one count for each failure reason, and the
    newest message and event times.
    """
    reason = F.col("failure_reason")
    measures = {
        "raw": F.count(F.lit(1)),
        "bronze": F.count_if("readable"),
        "silver": F.count_if(reason.isNull()),
        "dead_letter": F.count_if(reason.isNotNull()),
        **{name: F.count_if(reason == name) for name in REASONS},
        "newest_message": F.unix_micros(F.max("timestamp")),
        "newest_event": F.unix_micros(F.max(F.when(F.col("readable"), F.col("trade.event_time")))),
    }
    return decoded.observe(OBSERVED, *[measure.alias(name) for name, measure in measures.items()])


class StageCounters(StreamingQueryListener):
    """Totals of the observed stage counts of all queries, by stage and reason, and the lag of the newest message.

    A batch that runs again replaces its own counts, so a restart counts nothing twice. One whose rows the sink had
    committed before the restart is not run again and reports none; what it reported before stays.
    """

    def __init__(self) -> None:
        super().__init__()
        self._lock = threading.Lock()
        self._batches: dict[tuple[str, int], dict[str, int | None]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.take(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def take(self, progress) -> None:
        row = progress.observedMetrics.get(OBSERVED)
        counts = row.asDict() if row else {}
        if counts.get("raw"):
            with self._lock:
                self._fold()
                self._batches[str(progress.id), progress.batchId] = counts

    def _fold(self) -> None:
        """Keeps one sum for each query beside its newest batches, which alone can run again."""
        for query in {key[0] for key in self._batches}:
            numbers = sorted(n for q, n in self._batches if q == query)
            if len(numbers) > 100:
                settled = [self._batches.pop((query, n)) for n in numbers[:50]]
                self._batches[query, -1] = _total(settled)

    def totals(self) -> dict[str, int]:
        """Messages by stage, and by reason for those refused."""
        with self._lock:
            total = _total(list(self._batches.values()))
        return {name: value for name, value in total.items() if not name.startswith("newest_") and value}

    def lag_seconds(self) -> float | None:
        """Newest message time less newest readable event time, over all batches."""
        with self._lock:
            total = _total(list(self._batches.values()))
        message, event = total.get("newest_message"), total.get("newest_event")
        return None if message is None or event is None else (message - event) / 1_000_000


def _total(batches: list[dict[str, int | None]]) -> dict[str, int | None]:
    total: dict[str, int | None] = {}
    for batch in batches:
        for name, value in batch.items():
            if value is not None:
                before = total.get(name)
                total[name] = value if before is None else max(before, value) if name.startswith("newest_") else before + value
            else:
                total.setdefault(name, None)
    return total
