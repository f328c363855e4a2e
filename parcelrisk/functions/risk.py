"""Risk banding, alert text, reason text and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelrisk import config as C
from parcelrisk.functions.common import col_, np_round

# --- fixed values: display labels -----------------------------------------------
ACTION_LABELS = (("REAGENDAR_SMS", "📱 Reagendar SMS"),
                 ("CAMBIAR_FRANJA", "🕐 Cambiar franja"),
                 ("ENTREGA_NORMAL", "✅ Normal"))
ZONE_TYPE_LABELS = (("residential", "Residencial"), ("offices", "Oficinas"),
                    ("historic_center", "Centro histórico"), ("industrial", "Industrial"))
PRODUCT_LABELS = (("standard", "📦 Estándar"), ("fragile", "⚠️ Frágil"),
                  ("bulky", "🏗️ Voluminoso"), ("high_value", "💎 Alto valor"),
                  ("signature_required", "✍️ Firma requerida"))
RISK_BADGES = (("HIGH", "🔴 ALTO"), ("MEDIUM", "🟡 MEDIO"), ("LOW", "🟢 BAJO"))
EMPTY_LABEL = "—"
# reason factors, in display order
REASON_RAIN = "🌧️ Lluvia"
REASON_RETRY = "🔁 Reintento"
REASON_HISTORIC = "🏛️ Centro histórico"
REASON_DRIVER = "👷 Conductor bajo"
REASON_RECIPIENT = "📬 Dest. problemático"
REASON_ATTEMPTS = "🔄 {} intentos"
REASON_FRAGILE = "⚠️ Frágil"
REASON_SEPARATOR = " · "
# alert message template: sender, id, City, percent
SMS_SENDER = "Entregas"
SMS_TEMPLATE = ("%s: Su entrega %s en %s tiene un %d%% de probabilidad de fallo hoy. "
                "Le proponemos cambiar de franja horaria. Responda SI para reprogramar.")


def risk_level(prob: str | Column, threshold: float | Column = C.DEFAULT_THRESHOLD,
               high_multiplier: float = C.HIGH_MULTIPLIER) -> Column:
    p = col_(prob)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (F.when(p >= t * F.lit(high_multiplier), F.lit("HIGH"))
            .when(p >= t, F.lit("MEDIUM")).otherwise(F.lit("LOW")))


def risk_action(level: str | Column) -> Column:
    lv = col_(level)
    return (F.when(lv == "HIGH", F.lit(C.ACTION_HIGH))
            .when(lv == "MEDIUM", F.lit(C.ACTION_MEDIUM)).otherwise(F.lit(C.ACTION_LOW)))


def round_prob(prob: str | Column) -> Column:
    """Probability to 4 decimals, half-even."""
    return np_round(prob, 4)


def capitalize(s: str | Column) -> Column:
    """Upper first character, lower the rest (Python ``str.capitalize``)."""
    c = col_(s)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def percent_int(prob: str | Column) -> Column:
    """round(p * 100) with half-even ties, as an int."""
    return F.rint(col_(prob) * F.lit(100.0)).cast("int")


def sms_message(delivery_id: str | Column, city: str | Column, prob: str | Column,
                sender: str = SMS_SENDER) -> Column:
    return F.format_string(SMS_TEMPLATE, F.lit(sender), col_(delivery_id), capitalize(city), percent_int(prob))


def label(c: str | Column, table) -> Column:
    """Map a code to its display label; unknown passes through; NULL or empty -> '—'."""
    m = F.create_map(*[F.lit(x) for kv in table for x in kv])
    v = col_(c)
    return F.coalesce(m[v], F.nullif(v, F.lit("")), F.lit(EMPTY_LABEL))


def risk_badge(level: str | Column) -> Column:
    """Unknown or NULL level shows the LOW badge."""
    m = F.create_map(*[F.lit(x) for kv in RISK_BADGES for x in kv])
    return F.coalesce(m[col_(level)], F.lit(RISK_BADGES[-1][1]))


def _truthy(c: Column) -> Column:
    return F.coalesce(c.cast("double") != 0, F.lit(False))


def reason_text(shap_reason: str | Column | None = "shap_reason") -> Column:
    """Up to seven human-readable factors joined by ' · '; model reason wins when present."""
    attempts = F.col("num_previous_attempts")
    parts = [
        F.when(_truthy(F.col("weather_rain")), F.lit(REASON_RAIN)),
        F.when(_truthy(F.col("is_retry")), F.lit(REASON_RETRY)),
        F.when(F.col("zone_type") == "historic_center", F.lit(REASON_HISTORIC)),
        F.when(F.col("driver_quality_score") < 0.5, F.lit(REASON_DRIVER)),
        F.when(F.col("recipient_failure_rate") > 0.5, F.lit(REASON_RECIPIENT)),
        F.when(attempts > 1, F.format_string(REASON_ATTEMPTS.replace("{}", "%d"), attempts.cast("int"))),
        F.when(_truthy(F.col("is_fragile")), F.lit(REASON_FRAGILE)),
    ]
    text = F.concat_ws(REASON_SEPARATOR, *parts)
    built = F.when(text == "", F.lit(EMPTY_LABEL)).otherwise(text)
    if shap_reason is None:
        return built
    sr = col_(shap_reason)
    return F.when(sr.isNotNull() & (sr != ""), sr).otherwise(built)


def percent_text(prob: str | Column) -> Column:
    """Probability as a percent with one decimal, e.g. '67.1'."""
    return F.format_string("%.1f", col_(prob) * F.lit(100.0))


def model_version(name: str | Column, saved_at: str | Column | None) -> Column:
    n = col_(name)
    if saved_at is None:
        return F.concat(n, F.lit("_unknown"))
    return F.concat(n, F.lit("_"), F.coalesce(col_(saved_at).cast("string"), F.lit("unknown")))
