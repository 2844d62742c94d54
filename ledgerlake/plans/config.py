"""Lake layout: every path the pipelines use, derived from one root."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from ledgerlake import constants as K


@dataclass(frozen=True)
class LakeConfig:
    root: str
    db: str = "loan_lake"
    source_table: str = K.SOURCE_TABLE
    source_system: str = K.SOURCE_SYSTEM
    # Re-read margin behind the watermark (late commits); None = strict ">".
    lookback: dt.timedelta | None = None
    # Where the first extraction starts (UTC); the default is the source platform's.
    first_watermark: dt.datetime | str = K.DEFAULT_WATERMARK
    # Streaming progress; None = "<root>/_checkpoints", which outlives every application.
    checkpoints: str | None = None

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def checkpoint(self, query: str) -> str:
        return f"{(self.checkpoints or self._p('_checkpoints')).rstrip('/')}/{query}"

    @property
    def bronze_master(self) -> str:
        return self._p("bronze", "loan_master")

    @property
    def bronze_events(self) -> str:
        return self._p("bronze", "loan_events")

    @property
    def bronze_events_compact(self) -> str:
        return self._p("bronze", "loan_events_compact")

    @property
    def compacted(self) -> str:
        return self._p("_control", "loan_events_compacted")

    @property
    def silver_master(self) -> str:
        return self._p("silver", "loan_master")

    @property
    def silver_master_versions(self) -> str:
        return self._p("silver", "loan_master_incremental")

    @property
    def history(self) -> str:
        return self._p("silver", "loan_master_history")

    @property
    def history_months(self) -> str:
        return self._p("_control", "history_months")

    @property
    def silver_events(self) -> str:
        return self._p("silver", "loan_events")

    @property
    def silver_events_incremental(self) -> str:
        return self._p("silver", "loan_events_by_date")

    @property
    def gold(self) -> str:
        return self._p("gold")

    def gold_table(self, name: str) -> str:
        return self._p("gold", name)

    @property
    def watermarks(self) -> str:
        return self._p("_control", "watermarks")

    @property
    def quarantine(self) -> str:
        return self._p("_control", "quarantine", self.source_table)

    @property
    def stream_metrics(self) -> str:
        return self._p("_control", "stream_metrics")

    @property
    def unreachable(self) -> str:
        return self._p("_control", "unreachable")

    @property
    def versions(self) -> str:
        return self._p("_control", "versions")

    @property
    def silver_event_dates(self) -> str:
        return self._p("_control", "silver_event_dates")
