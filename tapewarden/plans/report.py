"""The analyst's report: two filtered inputs and one frame per panel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from tapewarden.config import DISPLAY_ZONE, DetectionConfig
from tapewarden.functions.timestamps import to_display_zone
from tapewarden.operators import reports
from tapewarden.operators.alerts import known_symbols, search_alerts, within_lookback
from tapewarden.plans.pump_dump import matched_pairs


@dataclass(frozen=True)
class Report:
    """Wash alerts and matched pairs after all filters. Panels are lazy."""

    wash: DataFrame
    pairs: DataFrame
    symbols: Sequence[str] | None

    def panels(self) -> dict[str, DataFrame]:
        dimension = reports.symbol_dimension(
            self.wash.select("symbol").unionByName(self.pairs.select("symbol")), self.symbols
        )
        return {
            "overview": reports.overview(self.wash, self.pairs),
            "timeline": reports.timeline(self.wash, self.pairs),
            "wash_severity": reports.severity_breakdown(self.wash),
            "average_zscore": reports.average_zscore(self.wash),
            "recent_wash": reports.recent_wash_table(self.wash),
            "pair_severity": reports.severity_breakdown(self.pairs),
            "pair_points": reports.pair_points(self.pairs),
            "recent_pairs": reports.pair_table(self.pairs),
            "symbol_risk": reports.symbol_risk(self.wash, self.pairs, dimension),
        }


def build_report(
    wash_alerts: DataFrame,
    pump_dump_sweep: DataFrame,
    config: DetectionConfig,
    symbol: str | None = None,
    severity: str | None = None,
    lookback_minutes: int | None = None,
    as_of: Column | None = None,
    zone: str | None = DISPLAY_ZONE,
) -> Report:
    """Report over the wash alert table and the pump-and-dump sweep table.

    Panels count all rows that pass the filters; only the tables of recent rows
    are cut. The look-back counts wash alerts by detection and pairs by the
    start of the pump. ``zone`` shifts detection times for display.
    """
    wash, sweep = wash_alerts, pump_dump_sweep
    if config.symbols is not None:
        wash, sweep = known_symbols(wash, config.symbols), known_symbols(sweep, config.symbols)
    wash = within_lookback(wash, "detected_at", lookback_minutes, as_of)
    # A pair's look-back is by its pump, and its dump is never earlier.
    sweep = within_lookback(sweep, "window_start", lookback_minutes, as_of)
    wash = search_alerts(wash, symbol, severity)
    pairs = matched_pairs(sweep, config, symbol, severity)
    if zone is not None:
        wash, pairs = to_display_zone(wash, zone), to_display_zone(pairs, zone)
    return Report(wash, pairs, config.symbols)
