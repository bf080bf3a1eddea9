"""Texts and marker styles for a status map."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- Fixed values: the labels and colours users of the map know ----------------------------

STATE_LABELS = {
    "GREEN": "Verde",
    "RED": "Vermelho",
    "YELLOW": "Amarelo",
    "FLASHING_YELLOW": "Amarelo intermitente",
    "UNKNOWN": "Desconhecido",
}
FRESHNESS_LABELS = {
    "FRESH": "Dados atualizados",
    "STALE": "Dados desatualizados",
    "UNKNOWN": "Sem dados",
}
STATE_COLORS = {
    "GREEN": "#22c55e",
    "RED": "#ef4444",
    "YELLOW": "#eab308",
    "FLASHING_YELLOW": "#f97316",
    "UNKNOWN": "#94a3b8",
}
SEVERE_STROKE, NORMAL_STROKE = "#dc2626", "#ffffff"
SEVERE_RADIUS, NORMAL_RADIUS = 11, 8
SEVERE_WEIGHT, NORMAL_WEIGHT = 3, 2
SEVERE_CLASS, NORMAL_CLASS = "bottleneck-marker", "signal-marker"
FILL_OPACITY = 0.95
BADGE_CLASS = "health-"
NO_TELEMETRY_STATE = "Sem telemetria"
NO_TELEMETRY_POPUP = "Sem telemetria recente"
SEVERE_TAG = "Gargalo"
SEVERE_POPUP = "⚠ Gargalo severo"
MISSING = "—"
ONE_INTERSECTION, MANY_INTERSECTIONS = "cruzamento", "cruzamentos"


def lookup(values: dict[str, str], key: Column, default: Column) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), default)


def state_label(state: Column) -> Column:
    return lookup(STATE_LABELS, state, state)


def state_color(state: Column) -> Column:
    return lookup(STATE_COLORS, state, F.lit(STATE_COLORS["UNKNOWN"]))


def freshness_label(status: Column) -> Column:
    status = F.coalesce(status, F.lit("UNKNOWN"))
    return lookup(FRESHNESS_LABELS, status, status)


def whole_number(value: Column, unit: str) -> Column:
    """Rounded half up, then the unit; a dash when unknown."""
    text = F.concat(F.round(value).cast("bigint").cast("string"), F.lit(unit))
    return F.coalesce(text, F.lit(MISSING))


def one_decimal(value: Column) -> Column:
    return F.when(value.isNull(), F.lit(MISSING)).otherwise(F.format_string("%.1f", value))


def count_label(count: Column) -> Column:
    noun = F.when(count == 1, F.lit(ONE_INTERSECTION)).otherwise(F.lit(MANY_INTERSECTIONS))
    return F.concat_ws(" ", count.cast("string"), noun)


def lag_title(freshness: Column, lag: Column) -> Column:
    """Worst delay as text, only while the data is fresh."""
    text = F.concat(
        F.lit("Atraso máximo: "), F.round(lag).cast("bigint").cast("string"), F.lit("s")
    )
    return F.when(freshness == "FRESH", text)
