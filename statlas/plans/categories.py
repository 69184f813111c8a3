"""Category plans: which indicators each category expects, from which source, in which rubric group.

The plans are data: scoring runs once over all categories (operators/scoring.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlas.operators import evidence, scoring

# Minimum number of sources, allowed proxy distances in years, rubric groups with weights.
CATEGORIES = {
    "domestic_violence": (2, (1, 2), {"pts_state_terror": 0.3, "cirights_physint_repression": 0.35, "ucdp_one_sided_violence": 0.2, "vdem_civil_liberties_repression": 0.15}),
    "economic_wellbeing": (1, (1,), {"wdi_per_capita_prosperity": 0.45, "wdi_scale_openness_investment": 0.25, "bti_economic_transformation": 0.3}),
    "effectiveness": (2, (1,), {"wgi_governance": 0.45, "vdem_governance_accountability": 0.35, "bti_governance": 0.2}),
    "integrity": (2, (1,), {"wgi_control_of_corruption": 0.35, "vdem_corruption_composite": 0.35, "ti_cpi": 0.3}),
    "international_peace": (2, (1, 2), {"ucdp_conflict_involvement": 0.65, "sipri_military_expenditure": 0.35}),
    "nuclear": (1, (1, 2), {"fas_nuclear_forces": 0.6, "sipri_yearbook_ch7_nuclear_forces": 0.4}),
    "political_freedom": (2, (1,), {"vdem_democracy_liberty": 0.5, "bti_political_transformation": 0.3, "rsf_press_freedom": 0.2}),
    "social_wellbeing": (2, (1,), {"hdi_anchor": 0.4, "health_signal": 0.2, "education_signal": 0.15, "income_signal": 0.15, "inequality_signal": 0.1}),
}

# Category, variable, role, direction, owning source, rubric group.
PLAN = """
domestic_violence pts_amnesty_score required lower_is_better pts pts_state_terror
domestic_violence pts_human_rights_watch_score preferred lower_is_better pts pts_state_terror
domestic_violence pts_state_dept_score preferred lower_is_better pts pts_state_terror
domestic_violence cirights_physint required higher_is_better cirights cirights_physint_repression
domestic_violence cirights_repression preferred higher_is_better cirights cirights_physint_repression
domestic_violence cirights_civpol fallback higher_is_better cirights cirights_physint_repression
domestic_violence cirights_disap preferred higher_is_better cirights cirights_physint_repression
domestic_violence cirights_kill preferred higher_is_better cirights cirights_physint_repression
domestic_violence cirights_polpris preferred higher_is_better cirights cirights_physint_repression
domestic_violence cirights_tort preferred higher_is_better cirights cirights_physint_repression
domestic_violence ucdp_onesided_events preferred lower_is_better ucdp ucdp_one_sided_violence
domestic_violence ucdp_onesided_fatalities preferred lower_is_better ucdp ucdp_one_sided_violence
domestic_violence vdem_v2x_clphy preferred higher_is_better vdem vdem_civil_liberties_repression
domestic_violence vdem_v2x_clpol fallback higher_is_better vdem vdem_civil_liberties_repression
domestic_violence vdem_v2x_clpriv fallback higher_is_better vdem vdem_civil_liberties_repression
domestic_violence vdem_v2csreprss fallback lower_is_better vdem vdem_civil_liberties_repression
domestic_violence vdem_v2clkill fallback lower_is_better vdem vdem_civil_liberties_repression
economic_wellbeing wdi_gdp_per_capita required higher_is_better world_bank_wdi wdi_per_capita_prosperity
economic_wellbeing wdi_gdp_per_capita_ppp_constant_2017 required higher_is_better world_bank_wdi wdi_per_capita_prosperity
economic_wellbeing wdi_gdp_current_usd preferred higher_is_better world_bank_wdi wdi_scale_openness_investment
economic_wellbeing wdi_gdp_constant_2015_usd preferred higher_is_better world_bank_wdi wdi_scale_openness_investment
economic_wellbeing wdi_gni_per_capita_atlas preferred higher_is_better world_bank_wdi wdi_per_capita_prosperity
economic_wellbeing wdi_exports_pct_gdp fallback higher_is_better world_bank_wdi wdi_scale_openness_investment
economic_wellbeing wdi_imports_pct_gdp fallback higher_is_better world_bank_wdi wdi_scale_openness_investment
economic_wellbeing wdi_fdi_inflows_current_usd fallback higher_is_better world_bank_wdi wdi_scale_openness_investment
economic_wellbeing wdi_population fallback higher_is_better world_bank_wdi wdi_scale_openness_investment
economic_wellbeing bti_q6_socioeconomic_development preferred higher_is_better bti bti_economic_transformation
economic_wellbeing bti_q7_market_competition preferred higher_is_better bti bti_economic_transformation
economic_wellbeing bti_q11_economic_performance preferred higher_is_better bti bti_economic_transformation
effectiveness wgi_voice_and_accountability preferred higher_is_better wgi wgi_governance
effectiveness wgi_political_stability preferred higher_is_better wgi wgi_governance
effectiveness wgi_government_effectiveness required higher_is_better wgi wgi_governance
effectiveness wgi_regulatory_quality preferred higher_is_better wgi wgi_governance
effectiveness wgi_rule_of_law required higher_is_better wgi wgi_governance
effectiveness vdem_v2x_jucon preferred higher_is_better vdem vdem_governance_accountability
effectiveness vdem_v2xlg_legcon preferred higher_is_better vdem vdem_governance_accountability
effectiveness vdem_v2x_accountability required higher_is_better vdem vdem_governance_accountability
effectiveness vdem_v2x_mpi preferred higher_is_better vdem vdem_governance_accountability
effectiveness vdem_v2x_regime fallback higher_is_better vdem vdem_governance_accountability
effectiveness bti_governance_index required higher_is_better bti bti_governance
effectiveness bti_governance_performance preferred higher_is_better bti bti_governance
integrity wgi_control_of_corruption required higher_is_better wgi wgi_control_of_corruption
integrity vdem_v2x_corr required lower_is_better vdem vdem_corruption_composite
integrity vdem_v2x_execorr preferred lower_is_better vdem vdem_corruption_composite
integrity vdem_v2x_pubcorr preferred lower_is_better vdem vdem_corruption_composite
integrity cpi_score required higher_is_better ti_cpi ti_cpi
international_peace ucdp_state_based_events preferred lower_is_better ucdp ucdp_conflict_involvement
international_peace ucdp_state_based_fatalities required lower_is_better ucdp ucdp_conflict_involvement
international_peace ucdp_intl_events preferred lower_is_better ucdp ucdp_conflict_involvement
international_peace ucdp_intl_fatalities preferred lower_is_better ucdp ucdp_conflict_involvement
international_peace sipri_milex_share_of_gdp preferred lower_is_better sipri_milex sipri_military_expenditure
international_peace sipri_milex_per_capita fallback lower_is_better sipri_milex sipri_military_expenditure
international_peace sipri_milex_constant_usd fallback lower_is_better sipri_milex sipri_military_expenditure
international_peace sipri_milex_share_of_govt_spending fallback lower_is_better sipri_milex sipri_military_expenditure
nuclear fas_operational_strategic preferred lower_is_better fas fas_nuclear_forces
nuclear fas_operational_nonstrategic fallback lower_is_better fas fas_nuclear_forces
nuclear fas_reserve_nondeployed fallback lower_is_better fas fas_nuclear_forces
nuclear fas_military_stockpile preferred lower_is_better fas fas_nuclear_forces
nuclear fas_total_inventory required lower_is_better fas fas_nuclear_forces
nuclear sipri_yearbook_ch7_nuclear_warheads_total_inventory required lower_is_better sipri_yearbook_ch7 sipri_yearbook_ch7_nuclear_forces
nuclear sipri_yearbook_ch7_nuclear_warheads_deployed preferred lower_is_better sipri_yearbook_ch7 sipri_yearbook_ch7_nuclear_forces
nuclear sipri_yearbook_ch7_nuclear_warheads_retired fallback higher_is_better sipri_yearbook_ch7 sipri_yearbook_ch7_nuclear_forces
political_freedom vdem_v2x_polyarchy required higher_is_better vdem vdem_democracy_liberty
political_freedom vdem_v2x_libdem required higher_is_better vdem vdem_democracy_liberty
political_freedom vdem_v2x_freexp preferred higher_is_better vdem vdem_democracy_liberty
political_freedom vdem_v2x_frassoc_thick preferred higher_is_better vdem vdem_democracy_liberty
political_freedom vdem_v2x_suffr preferred higher_is_better vdem vdem_democracy_liberty
political_freedom vdem_v2x_rule preferred higher_is_better vdem vdem_democracy_liberty
political_freedom vdem_v2x_civlib preferred higher_is_better vdem vdem_democracy_liberty
political_freedom rsf_press_freedom_score preferred higher_is_better rsf_press_freedom rsf_press_freedom
political_freedom rsf_press_freedom_political_context fallback higher_is_better rsf_press_freedom rsf_press_freedom
political_freedom bti_status_index preferred higher_is_better bti bti_political_transformation
political_freedom bti_democracy_status preferred higher_is_better bti bti_political_transformation
political_freedom bti_q1_stateness fallback higher_is_better bti bti_political_transformation
political_freedom bti_q2_political_participation fallback higher_is_better bti bti_political_transformation
political_freedom bti_q3_rule_of_law fallback higher_is_better bti bti_political_transformation
political_freedom bti_q4_democratic_institutions fallback higher_is_better bti bti_political_transformation
political_freedom bti_q5_political_social_integration fallback higher_is_better bti bti_political_transformation
social_wellbeing undp_hdi_hdi required higher_is_better undp_hdi hdi_anchor
social_wellbeing undp_hdi_life_expectancy preferred higher_is_better undp_hdi health_signal
social_wellbeing undp_hdi_expected_years_schooling preferred higher_is_better undp_hdi education_signal
social_wellbeing undp_hdi_mean_years_schooling preferred higher_is_better undp_hdi education_signal
social_wellbeing undp_hdi_gni_per_capita preferred higher_is_better undp_hdi income_signal
social_wellbeing who_gho_life_expectancy fallback higher_is_better who_gho_api health_signal
social_wellbeing who_gho_under5_mortality preferred lower_is_better who_gho_api health_signal
social_wellbeing who_gho_dtp3_immunization preferred higher_is_better who_gho_api health_signal
social_wellbeing who_gho_hepb3_immunization fallback higher_is_better who_gho_api health_signal
social_wellbeing who_gho_bcg_immunization fallback higher_is_better who_gho_api health_signal
social_wellbeing wdi_life_expectancy_at_birth fallback higher_is_better world_bank_wdi health_signal
social_wellbeing wdi_under5_mortality_per_1000 fallback lower_is_better world_bank_wdi health_signal
social_wellbeing wdi_literacy_rate_adult preferred higher_is_better world_bank_wdi education_signal
social_wellbeing wdi_secondary_school_enrollment preferred higher_is_better world_bank_wdi education_signal
social_wellbeing wdi_gini_index preferred lower_is_better world_bank_wdi inequality_signal
social_wellbeing vdem_v2x_egal preferred higher_is_better vdem inequality_signal
social_wellbeing vdem_v2clsocgrp_ord fallback higher_is_better vdem inequality_signal
""".strip()

#: Categories whose insufficient rows carry a fixed pair of flags, and those where only the owning source counts.
FIXED_FLAGS = ("social_wellbeing", "integrity")
OWNER_ONLY = ("nuclear",)


def plan(spark: SparkSession) -> DataFrame:
    rows = [tuple(line.split()) for line in PLAN.splitlines()]
    return spark.createDataFrame(rows, "category string, variable_name string, role string, direction string, owning_source string, rubric_group string")


def weights(spark: SparkSession) -> DataFrame:
    rows = [(c, g, w) for c, (_, _, groups) in CATEGORIES.items() for g, w in groups.items()]
    return spark.createDataFrame(rows, "category string, rubric_group string, weight double")


def categories(spark: SparkSession) -> DataFrame:
    rows = [(c, least, c in FIXED_FLAGS, c in OWNER_ONLY) for c, (least, _, _) in CATEGORIES.items()]
    return spark.createDataFrame(rows, "category string, min_sources int, fixed_flags boolean, owner_only boolean")


def evidence_for(observations: DataFrame, entities: DataFrame, target_year: int) -> tuple[DataFrame, DataFrame]:
    """(best observations, missing indicators) of every entity and planned indicator.

    observations: country_iso3, year, source_id, observation_id, variable_name, normalized_value. entities: country_iso3. Each planned
    indicator gives exactly one row in one of the two. Only the owning source of a variable is asked.
    """
    spark = observations.sparkSession
    planned = plan(spark).drop("direction")
    found = []
    for years in sorted({y for _, y, _ in CATEGORIES.values()}):
        own = F.broadcast(planned.where(F.col("category").isin([c for c, (_, y, _) in CATEGORIES.items() if y == years])).select("category", "variable_name", F.col("owning_source").alias("source_id")))
        rows = observations.join(own, ["variable_name", "source_id"])
        targets = rows.select("country_iso3", "category", "variable_name").distinct().withColumn("target_year", F.lit(target_year))
        found.append(evidence.best_observations(rows, targets, ["country_iso3", "category", "variable_name"], years))
    best = found[0]
    for f in found[1:]:
        best = best.unionByName(f)
    best = best.join(entities, "country_iso3", "left_semi")
    expected = entities.crossJoin(F.broadcast(planned.select("category", "variable_name", F.col("owning_source").alias("source_id"), "role")))
    gone = evidence.missing_indicators(expected, best, observations.select("source_id").distinct(), ["country_iso3", "category"])
    return best, gone


def score_all(observations: DataFrame, entities: DataFrame, target_year: int) -> DataFrame:
    """Scores of all categories for all entities."""
    spark = observations.sparkSession
    best, _ = evidence_for(observations, entities, target_year)
    return scoring.scored(best, plan(spark).drop("direction"), weights(spark), categories(spark), entities)
