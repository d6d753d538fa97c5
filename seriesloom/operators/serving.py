"""Serving: latest stored features next to refreshed ones, and alert levels for predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hours_between, safe_ratio, signed_fmt
from .quality import broadcast_row


def serve_features(
    history: DataFrame,
    incoming: DataFrame,
    ts: str,
    refresh: Sequence[str],
    stored: Sequence[str],
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
) -> DataFrame:
    """Incoming rows with the latest stored features and freshly computed lag, diff and velocity.

    Only the newest history row per series matters. It is found by a map-side reduced aggregation and
    joined by series; without keys it is one row, attached as a scalar subquery.
    """
    wanted = list(dict.fromkeys([ts, *refresh, *stored]))
    newest = F.max_by(
        F.struct(*[F.col(c) for c in wanted]), F.struct(ts, *[F.col(t) for t in tie])
    ).alias("_last")
    if keys:
        latest = history.groupBy(*keys).agg(newest)
        joined = incoming.join(latest, list(keys), "left")
    else:
        joined = broadcast_row(incoming, history.agg(newest), "_one").select(
            *incoming.columns, F.col("_one")["_last"].alias("_last")
        )
    last = F.col("_last")
    hours = hours_between(last[ts], F.col(ts))
    out = [*incoming.columns, *[last[c].alias(c) for c in stored]]
    for c in refresh:
        change = F.col(c) - last[c]
        out += [
            last[c].alias(f"{c}_lag_1h"),
            change.alias(f"{c}_diff_1h"),
            safe_ratio(change, last[c]).alias(f"{c}_diff_pct"),
            safe_ratio(change, hours).alias(f"{c}_velocity"),
        ]
    return joined.select(*[F.col(c) if isinstance(c, str) else c for c in out])


# fixed values: message formats per level, with the horizon, the prediction and the signed delta
ALERT_MESSAGES = {
    "RED": "KRİTİK: {h}h sonrası Si tahmini ({pred}) sınırlar dışında.",
    "YELLOW": "UYARI: {h}h içinde {delta} sapma bekleniyor.",
    "GREEN": "{h}h ufku için çalışma rejimi stabil.",
}


def _filled(template: str, parts: Mapping[str, Column]) -> Column:
    """A text column from a template with named places."""
    out = [F.lit("")]
    for text, name, _, _ in Formatter().parse(template):
        out.append(F.lit(text))
        if name:
            out.append(parts[name])
    return F.concat(*out)


def classify_alert(
    df: DataFrame,
    pred: str,
    current: str,
    horizon: str = "horizon_hours",
    hi: float = 0.70,
    lo: float = 0.20,
    dev: float = 0.10,
    messages: Mapping[str, str] = ALERT_MESSAGES,
) -> DataFrame:
    """Prediction and delta rounded to four places, alert level and message.

    RED outside [lo, hi], else YELLOW when the delta exceeds ``dev``, else GREEN; all comparisons are
    strict. Without a prediction there is no level.
    """
    rounded = df.withColumn("prediction", F.round(F.col(pred), 4))
    rounded = rounded.withColumn("delta", F.round(F.col("prediction") - F.col(current), 4))
    p, d = F.col("prediction"), F.col("delta")
    red = (p > F.lit(hi)) | (p < F.lit(lo))
    yellow = F.abs(d) > F.lit(dev)
    short = F.regexp_replace(F.format_string("%.4f", p), "(?<=[.][0-9]{1,4})0+$", "")
    parts = {"h": F.col(horizon).cast("string"), "pred": short, "delta": signed_fmt(d)}
    text = {level: _filled(template, parts) for level, template in messages.items()}
    level = F.when(red, "RED").when(yellow, "YELLOW").otherwise("GREEN")
    message = F.when(red, text["RED"]).when(yellow, text["YELLOW"]).otherwise(text["GREEN"])
    known = p.isNotNull()
    return rounded.select(
        "*", F.when(known, level).alias("alert"), F.when(known, message).alias("alert_msg")
    )
