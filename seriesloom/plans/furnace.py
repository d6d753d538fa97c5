"""Spec of the blast-furnace process: sensors, silicon target, validity rules, features, cleaning."""

from __future__ import annotations

from pyspark.sql import Column

from ..functions import diff_of, product, row_mean, row_spread, safe_ratio
from ..operators.blocks import HOUR
from ..operators.quality import rules_each
from ..operators.windows import Roll
from ..sources.contract import Contract
from .spec import CleaningStep, FeatureSpec, PlantSpec

# --- fixed values: column names, limits and feature names ---------------------------------------

TT = [f"Tt{i}" for i in range(1, 5)]
TP = [f"Tp{i}" for i in range(1, 11)]
FEED = ["Fb", "Th", "Tc", "Fo", "R"]
PRESSURE = ["Ph", "Pc", "Pt", "dP", "dPu", "dPl"]
GAS = ["CO2", "H2"]
TRACKED = ["Fb", "Th", "Tc", "dP", "CO2", "H2", "R"]
SI_LAGS = [1, 2, 3, 4, 8, 12]
HORIZONS = (2, 4, 6, 8)
PI = 3.14159

CONTRACT = Contract(
    groups={
        "feed": dict.fromkeys(FEED, "double"),
        "pressure": dict.fromkeys(PRESSURE, "double"),
        "gas": dict.fromkeys(GAS, "double"),
        "thermal": dict.fromkeys(TT + TP, "double"),
    },
    target={"Si": "double"},
)

VALIDITY = [
    "Th > Tc",
    "Th between 0 and 1500",
    "Tc between 0 and 150",
    "Fo between 0 and 35000",
    "Fb between 500 and 4500",
    "R between 1.2e0 and 8e0",
    "Pc > Pt",
    "dP between 0.2e0 and 2.5e0",
    "CO2 between 8 and 30",
    "H2 between 0.2e0 and 12e0",
    f"({' + '.join(TT)}) / 4e0 < ({' + '.join(TP)}) / 10e0",
]
# A NaN is greater than any number, so it fails every rule with an upper limit; these have none.
NOT_NAN = ["not isnan(Pc)", f"not isnan({' + '.join(TP)})"]

TRUSTED = "source_type = 'second' or (source_type = 'first' and is_outlier = 0)"

CLEANING = (
    CleaningStep(
        "feed",
        ["Th > Tc", "Th >= 0", "Tc >= 0", "Fo >= 0", "Fb > 500", "R < 6", "R > 0"],
        trim=["Fb", "Fo", "Th", "Tc", "R"],
        bounds_after_rules=True,
    ),
    CleaningStep(
        "pressure",
        ["Pc > Pt", "Ph > Pt", *rules_each(["Pt", "dP", "dPu", "dPl"], "{c} > 0"), "abs(dP - (dPu + dPl)) < 0.2e0"],
        trim=PRESSURE,
    ),
    CleaningStep(
        "gas",
        ["CO2 > 5", "CO2 < 35", "H2 > 0.1e0", "H2 < 10", "CO2 + H2 < 50"],
        trim=GAS,
    ),
    CleaningStep(
        "thermal",
        [
            *rules_each(TT + TP, "{c} > 0 and {c} < 1000"),
            f"({' + '.join(TT)}) / 4e0 < ({' + '.join(TP)}) / 10e0",
        ],
        trim=TT + TP,
        lo=0.02,
        hi=0.98,
    ),
    CleaningStep("target", ["Si > 0.15e0", "Si < 1.5e0"]),
)

# inputs of a scoring request that may be absent
DEFAULTS = {
    "Fo": 21.0,
    "Tc": 65.0,
    "Ph": 2.1,
    "Pc": 1.8,
    "Pt": 1.2,
    **dict.fromkeys(TT, 120.0),
    **dict.fromkeys(TP, 450.0),
}

ANOMALY_INPUTS = ["Si", "Th", "Tc", "Fb", "CO2", "H2"]

# five operating regimes to try a model on: name, description, expected silicon range, values of SCENARIO_SENSORS
SCENARIO_SENSORS = [
    "Fb", "Th", "R", "dP", "CO2", "H2", "Si", "Tc", "Ph", "Pc", "Pt", *TT, *TP,
]
SCENARIOS = [
    ("normal_operation", "steady regime: middle silicon, balanced burden, blast and temperature, usual gas and heat profile",
     0.40, 0.50, [
        4100.0, 1120.0, 4.50, 1.20, 22.5, 5.0, 0.45, 95.0, 2.50, 2.20, 1.50,
        145.0, 152.0, 148.0, 150.0,
        280.0, 310.0, 340.0, 365.0, 380.0, 390.0, 385.0, 370.0, 350.0, 320.0]),
    ("high_silicon_risk", "hot regime with rising silicon: less blast, hotter air, more coke and hydrogen, high top temperatures",
     0.65, 0.80, [
        3650.0, 1185.0, 3.75, 1.05, 20.8, 7.2, 0.72, 125.0, 2.85, 2.60, 1.75,
        195.0, 205.0, 198.0, 202.0,
        320.0, 360.0, 410.0, 445.0, 465.0, 470.0, 460.0, 440.0, 415.0, 375.0]),
    ("low_silicon_risk", "cooling regime with falling silicon: much blast, cooler air, more ore for the coke, low top temperatures",
     0.22, 0.35, [
        4450.0, 1070.0, 5.20, 1.42, 24.2, 3.4, 0.28, 72.0, 2.15, 1.90, 1.25,
        115.0, 122.0, 118.0, 120.0,
        220.0, 245.0, 270.0, 290.0, 305.0, 310.0, 300.0, 285.0, 265.0, 240.0]),
    ("thermal_imbalance", "uneven heat around the furnace: temperatures differ strongly between sides, pressures out of line",
     0.50, 0.62, [
        3900.0, 1140.0, 4.20, 0.92, 21.5, 6.1, 0.55, 110.0, 2.30, 2.80, 1.10,
        135.0, 175.0, 128.0, 168.0,
        260.0, 290.0, 380.0, 295.0, 420.0, 310.0, 400.0, 275.0, 360.0, 300.0]),
    ("extreme_high_si", "silicon at the upper end: least blast, hottest air, highest hydrogen and temperatures",
     0.75, 0.85, [
        3550.0, 1195.0, 3.60, 0.98, 20.2, 7.8, 0.78, 128.0, 2.95, 2.75, 1.80,
        210.0, 225.0, 215.0, 220.0,
        340.0, 390.0, 450.0, 485.0, 495.0, 490.0, 475.0, 455.0, 430.0, 395.0]),
]


# --- features ------------------------------------------------------------------------------------


def _row_features() -> dict[str, Column]:
    """Features computed from one row alone."""
    mean_tp, mean_tt = row_mean(TP), row_mean(TT)
    heat = product("Fb", "Th")
    return {
        "mean_tp": mean_tp,
        "mean_tt": mean_tt,
        "tp_imbalance": row_spread(TP),
        "furnace_thermal_drop": diff_of("Th", mean_tt),
        "blast_heat_addition": diff_of("Th", "Tc"),
        "thermal_position_index": safe_ratio(mean_tp, mean_tt),
        "permeability_index": safe_ratio("Fb", "dP"),
        "pressure_distribution_ratio": safe_ratio("dPu", "dPl"),
        "specific_co2_generation": safe_ratio("CO2", "Fb"),
        "gas_reduction_ratio": safe_ratio("CO2", "H2"),
        "blast_heat_index": heat,
        "oxygen_enrichment_ratio": safe_ratio("Fo", "Fb"),
        "permeability_k_index": safe_ratio("Fb", "dP"),
        "specific_pressure_drop": safe_ratio("dP", "Fb"),
        "thermal_burden_balance": safe_ratio(heat, "R"),
        "gas_utilization_proxy": safe_ratio("CO2", "Fb"),
        "fb_th_ratio": safe_ratio("Fb", "Th"),
        "co2_h2_product": product("CO2", "H2"),
        "dp_r_product": product("dP", "R"),
    }


def _rolls() -> list[Roll]:
    h = HOUR
    return [
        Roll("Si_roll_mean_4h", "Si", "avg", 4 * h),
        Roll("Si_roll_std_4h", "Si", "stddev", 4 * h),
        Roll("Si_roll_mean_8h", "Si", "avg", 8 * h),
        Roll("Si_roll_mean_24h", "Si", "avg", 24 * h),
        *[Roll(f"{c}_roll_mean_4h", c, "avg", 4 * h) for c in TRACKED],
        Roll("tp_stability_4h", "tp_imbalance", "avg", 4 * h),
        Roll("thermal_drop_trend_4h", "furnace_thermal_drop", "avg", 4 * h),
        Roll("dP_roll_std_4h", "dP", "stddev", 4 * h),
        Roll("co2_volatility_1h", "CO2", "stddev", 1 * h),
        Roll("co2_volatility_4h", "CO2", "stddev", 4 * h),
        Roll("co2_gen_trend_4h", "specific_co2_generation", "avg", 4 * h),
    ]


def _column_order() -> list[str]:
    lagged = [f"Si_lag_{n}h" for n in SI_LAGS]
    lagged += ["Si_roll_mean_4h", "Si_roll_std_4h", "Si_roll_mean_8h", "Si_roll_mean_24h"]
    for c in TRACKED:
        lagged += [f"{c}_lag_1h", f"{c}_lag_4h", f"{c}_roll_mean_4h"]
    diffs = [f"{c}_{kind}" for c in ["Si", *TRACKED] for kind in ("diff_1h", "diff_pct")]
    return [
        "si_dt", "Si", *FEED, *PRESSURE, *GAS, *TT, *TP,
        "delta_t_hours",
        "hour", "day_of_week", "day_of_month", "month", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
        *lagged,
        "mean_tp", "mean_tt", "tp_imbalance", "furnace_thermal_drop", "blast_heat_addition",
        "thermal_position_index", "tp_stability_4h", "thermal_drop_trend_4h",
        "permeability_index", "pressure_distribution_ratio", "dP_roll_std_4h",
        "specific_co2_generation", "gas_reduction_ratio", "co2_volatility_1h", "co2_volatility_4h",
        "co2_gen_trend_4h",
        "blast_heat_index", "oxygen_enrichment_ratio", "permeability_k_index", "specific_pressure_drop",
        "thermal_burden_balance", "gas_utilization_proxy", "fb_th_ratio", "co2_h2_product", "dp_r_product",
        "si_velocity", "th_velocity", "fb_velocity", "co2_velocity", "si_acceleration", "th_acceleration",
        *diffs,
        "next_si_dt", "hours_to_next_cast",
        *[f"target_Si_{h}h" for h in HORIZONS],
    ]


FEATURES = FeatureSpec(
    row_features=_row_features,
    lags={"Si": SI_LAGS, **{c: [1, 4] for c in TRACKED}},
    rolls=_rolls(),
    diffs=["Si", *TRACKED],
    velocities={"si": "Si", "th": "Th", "fb": "Fb", "co2": "CO2"},
    accelerations=["si", "th"],
    target="Si",
    horizons=HORIZONS,
    essential=["si_velocity", "th_acceleration", "permeability_index"],
    pi=PI,
    order=_column_order(),
)

FURNACE = PlantSpec(
    contract=CONTRACT, validity=[*VALIDITY, *NOT_NAN], trusted=TRUSTED, features=FEATURES, cleaning=CLEANING
)

# what the feature plan adds to tell time and future apart from inputs
NOT_FEATURES = [
    "si_dt",
    FEATURES.next_time,
    FEATURES.next_hours,
    "is_anomalous",
    *[f"target_{FEATURES.target}_{h}h" for h in FEATURES.horizons],
]
