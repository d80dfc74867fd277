"""Current state, reasons and advice for every station."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe.functions.aqi import category, score_aqi
from hazeframe.functions.casts import to_number
from hazeframe.operators import columns as K
from hazeframe.operators.windows import last_valid, latest_row, o3_8hr

# Labels, texts and advice of the report.
LABELS = {"pm25": "PM2.5", "pm10": "PM10", "no2": "NO2", "so2": "SO2", "o3": "O3", "nh3": "NH3"}
REASONS = {
    "DOMINANT": "Dominant pollutant: %s (subindex %s).",
    "O3_DIAGNOSTIC": "O3 diagnostic: raw_last=%s µg/m3  used_for_aqi=%s µg/m3  method=%s  col=%s",
    "LOW_WIND": "Low wind (%s m/s) — poor dispersion.",
    "LIGHT_WIND": "Light wind (%s m/s) — limited dispersion.",
    "HELPFUL_WIND": "Moderate/high wind (%s m/s) — helps dispersion.",
    "HIGH_HUMIDITY": "High humidity (%s%%) — hygroscopic growth can increase PM.",
    "RAIN": "Recent precipitation (%s) — washout likely reduced PM.",
    "LOW_VISIBILITY": "Low visibility (%s) — heavy particulate loading.",
    "HIGH_TRAFFIC": "High vehicle count (%s) — likely higher vehicular PM/NO2.",
    "MODERATE_TRAFFIC": "Moderate vehicle count (%s).",
    "LOW_SPEED": "Low avg traffic speed (%s km/h) — congestion contributes to emissions.",
    "NO_WEATHER": "Weather data not available in live feed.",
    "NO_TRAFFIC": "Traffic data not available in live feed.",
}
SUGGESTIONS = {
    "AVOID_EXERCISE": "Avoid outdoor exercise; use masks; reduce vehicle travel if possible.",
    "LIMIT_DUST": "Limit dusty outdoor activities; control construction dust.",
    "MONITOR": "Monitor updates; reduce exposure if sensitive.",
    "CUT_LOCAL_EMISSIONS": "Reduce local emissions (avoid burning, limit non-essential traffic) until dispersion improves.",
    "EXPECT_WASHOUT": "Pollution likely to improve after rain - check updated AQI later.",
}
ADVICE = (
    ("Good", "Enjoy outdoor activities.", "No special care needed."),
    ("Moderate", "Outdoor activity is fine for most people.", "Watch for symptoms and take breaks."),
    ("Unhealthy for Sensitive Groups", "Shorten long outdoor exertion.", "Prefer indoor activity."),
    ("Unhealthy", "Avoid long outdoor exertion.", "Stay indoors and keep medication at hand."),
    ("Very Unhealthy", "Stay indoors where possible.", "Do not go out; use filtered air."),
    ("Hazardous", "Stay indoors and wear a mask outside.", "Follow emergency advice."),
)


# Words by which the columns of a raw feed are found, in order of rank.
KEYWORDS = {
    "air": {"pm25": ("pm2.5", "pm2_5", "pm25", "pm2"), "pm10": ("pm10", "pm_10"), "no2": ("no2", "no_2"),
            "so2": ("so2", "so_2"), "nh3": ("nh3", "nh_3")},
    "weather": {"windspeed": ("wind_speed", "windspeed", "wind"), "humidity": ("humidity", "hum"),
                "precipitation": ("rain", "precip", "precipitation"), "visibility": ("vis", "visibility")},
    "traffic": {"vehicle_count": ("count", "vehicle", "volume", "veh_count", "vehicles"),
                "avg_speed": ("speed", "avg_speed", "avg_speed_km", "avg_speed_kph")},
}


def named(feed: DataFrame, kind: str, keep: Sequence[str]) -> DataFrame:
    """A raw feed with the report's names: columns are found by keyword and read as numbers,
    what is not found is left out. ``keep`` names the key, time and tie-break columns."""
    able = [c for c in feed.columns if c not in keep]
    found = {name: K.resolve(able, contains=words, keyword_major=True) for name, words in KEYWORDS[kind].items()}
    if kind == "air":
        found["o3"] = K.resolve(able, exact=K.O3_NAMES, prefix="o3")
    text = set(K.text_columns(feed))

    def number(c):
        return to_number(F.col(f"`{c}`")) if c in text else F.col(f"`{c}`").cast("double")

    return feed.select(*keep, *[number(c).alias(name) for name, c in found.items() if c])


def snapshot(air: DataFrame, weather: DataFrame | None, traffic: DataFrame | None, by: Sequence[str],
             ts: str, tie: str, pollutants: Sequence[str] = ("pm25", "pm10", "no2", "so2", "nh3")) -> DataFrame:
    """Last pollutant values, eight-hour ozone, newest weather row and newest traffic row.

    A pollutant without a column is null; without an ozone column the method is
    ``no_o3_column``. Bring raw feeds to these names with ``named``.
    """
    by = list(by)
    here = [p for p in pollutants if p in air.columns]
    out = last_valid(air, by, [ts, tie], here) if here else air.select(*by).distinct()
    out = out.withColumns({p: F.lit(None).cast("double") for p in pollutants if p not in here})
    if "o3" in air.columns:
        out = out.join(o3_8hr(air, by, ts, tie), by)
    else:
        nothing = F.lit(None).cast("double")
        out = out.withColumns({"o3_raw": nothing, "o3_used": nothing, "o3_method": F.lit("no_o3_column")})
    measures = {"weather": ("windspeed", "humidity", "precipitation", "visibility"),
                "traffic": ("vehicle_count", "avg_speed")}
    for name, side in (("weather", weather), ("traffic", traffic)):
        cols = measures[name]
        if side is None:
            out = out.withColumns({c: F.lit(None).cast("double") for c in cols})
            out = out.withColumn(f"has_{name}", F.lit(False))
            continue
        have = [c for c in cols if c in side.columns]
        newest = latest_row(side.select(*by, ts, tie, *have), by, [ts, tie]).drop(ts, tie)
        out = out.join(newest.withColumn(f"has_{name}", F.lit(True)), by, "left")
        out = out.withColumn(f"has_{name}", F.coalesce(F.col(f"has_{name}"), F.lit(False)))
        out = out.withColumns({c: F.lit(None).cast("double") for c in cols if c not in have})
    return out


def scored(snap: DataFrame) -> DataFrame:
    """Snapshot with sub-indices, index, dominant pollutant and category."""
    out = score_aqi(snap, "in_report", {"o3": "o3_used"})
    return out.withColumn("category", category(F.col("aqi"), "in"))


def _compact(items: list[Column]) -> Column:
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def _label() -> Column:
    return F.coalesce(*[F.when(F.col("dominant") == p, F.lit(l)) for p, l in LABELS.items()])


def _reasons(text: bool, o3_column: str = "o3") -> list[Column]:
    """One column per rule in report order: its code or its text, null where it does not hold."""
    wind, hum, rain, vis = (F.col(c) for c in ("windspeed", "humidity", "precipitation", "visibility"))
    cars, speed = F.col("vehicle_count"), F.col("avg_speed")
    top = F.coalesce(*[F.when(F.col("dominant") == p, F.col(f"si_{p}")) for p in LABELS])
    rules = (
        (F.col("dominant").isNotNull(), "DOMINANT", (_label(), top)),
        (F.lit(True), "O3_DIAGNOSTIC", (F.col("o3_raw"), F.col("o3_used"), F.col("o3_method"), F.lit(o3_column))),
        (wind < 2, "LOW_WIND", (wind,)),
        ((wind >= 2) & (wind < 4), "LIGHT_WIND", (wind,)),
        (wind >= 4, "HELPFUL_WIND", (wind,)),
        (hum > 75, "HIGH_HUMIDITY", (hum,)),
        (rain > 0, "RAIN", (rain,)),
        (vis < 2000, "LOW_VISIBILITY", (vis,)),
        (cars > 400, "HIGH_TRAFFIC", (cars,)),
        ((cars > 200) & (cars <= 400), "MODERATE_TRAFFIC", (cars,)),
        (speed < 20, "LOW_SPEED", (speed,)),
        (~F.col("has_weather"), "NO_WEATHER", ()),
        (~F.col("has_traffic"), "NO_TRAFFIC", ()),
    )

    def words(code, cols):
        if not text:
            return F.lit(code)
        return F.format_string(REASONS[code], *[c.cast("string") for c in cols]) if cols else F.lit(REASONS[code])

    return [F.when(cond, words(code, cols)) for cond, code, cols in rules]


def _suggestions(text: bool) -> list[Column]:
    dominant = F.col("dominant")

    def words(code):
        return F.lit(SUGGESTIONS[code] if text else code)

    return [
        F.when(dominant == "pm25", words("AVOID_EXERCISE")).when(dominant == "pm10", words("LIMIT_DUST"))
        .when(dominant.isNotNull(), words("MONITOR")),
        F.when(F.col("windspeed") < 2, words("CUT_LOCAL_EMISSIONS")),
        F.when(F.col("precipitation") > 0, words("EXPECT_WASHOUT")),
    ]


def reason_codes() -> Column:
    """Ordered reason codes of a scored snapshot."""
    return _compact(_reasons(False))


def suggestion_codes() -> Column:
    return _compact(_suggestions(False))


def report(scored_rows: DataFrame, by: Sequence[str], o3_column: str = "o3", now: Column | None = None) -> DataFrame:
    """Nested report document per station; stations without any sub-index give none.
    ``now`` is the time of the report, the current one by default."""
    values = [F.col("o3_used").alias("O3_used_µg/m3") if p == "o3" else F.col(p).alias(l) for p, l in LABELS.items()]
    return scored_rows.where("aqi is not null").select(
        *by, (F.current_timestamp() if now is None else now).alias("timestamp"), "aqi", "category",
        F.struct(*values).alias("pollutant_values_last"),
        F.struct(*[F.col(f"si_{p}").alias(l) for p, l in LABELS.items()]).alias("subindices"),
        _label().alias("dominant"),
        F.struct(F.col("o3_raw").alias("raw"), F.col("o3_used").alias("used"), F.col("o3_method").alias("method"),
                 F.lit(o3_column).alias("column")).alias("o3_diag"),
        F.struct(F.col("windspeed").alias("wind"), "humidity", F.col("precipitation").alias("precip"),
                 "visibility").alias("weather_snapshot"),
        F.struct("vehicle_count", "avg_speed").alias("traffic_snapshot"),
        _compact(_reasons(True, o3_column)).alias("reasons"), _compact(_suggestions(True)).alias("suggestions"))


def with_advice(df: DataFrame, category_col: str) -> DataFrame:
    """General and sensitive-group advice by category; the table has one row per category."""
    table = df.sparkSession.createDataFrame(
        list(ADVICE), f"{category_col} string, advice string, sensitive_advice string")
    return df.join(F.broadcast(table), category_col, "left")


def what_if(df: DataFrame, scenarios: dict[str, float], factors: Sequence[str],
            coefficients: dict[str, float], intercept: float) -> DataFrame:
    """Score a linear model per scenario with ``factors`` scaled, against the baseline.

    The scenarios are literals spread over each row, so nothing is joined.
    """
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(float(x)).alias("factor"))
                               for n, x in scenarios.items()])).alias("_s")
    rows = df.select("*", each).select(*df.columns, "_s.*")
    base = F.lit(float(intercept))
    moved = F.lit(float(intercept))
    for c, w in coefficients.items():
        base = base + F.lit(float(w)) * F.col(c)
        moved = moved + F.lit(float(w)) * F.col(c) * (F.col("factor") if c in factors else F.lit(1.0))
    return rows.withColumns({"baseline": base, "predicted": moved}).withColumn(
        "delta", F.col("predicted") - F.col("baseline"))


def what_if_fitted(df: DataFrame, model, scenarios: dict[str, float], factors: Sequence[str]) -> DataFrame:
    """Score a fitted pipeline once per scenario, with the ``factors`` among its features
    scaled, and once on the features as they are: scenario, factor, baseline, predicted and
    delta. The model itself predicts, so its scaling and any non-linear effect count.
    """
    base = model.transform(df).select(*df.columns, F.col("prediction").alias("baseline"))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(float(x)).alias("factor"))
                               for n, x in scenarios.items()])).alias("_s")
    rows = base.select("*", each).select(*base.columns, "_s.*")
    kept = [c for c in rows.columns if c not in factors]
    moved = rows.select(*kept, *[F.col(c).alias(f"_own_{c}") for c in factors], *[(F.col(c) * F.col("factor")).alias(c) for c in factors])
    scored = model.transform(moved)
    return scored.select(*[F.col(f"_own_{c}").alias(c) if c in factors else F.col(c) for c in df.columns], "scenario", "factor", "baseline",
                         F.col("prediction").alias("predicted"), (F.col("prediction") - F.col("baseline")).alias("delta"))
