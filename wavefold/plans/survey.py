"""Column vocabulary of the reference's survey tables.

Fixed values: these labels, codes and ranges must equal the reference's for
the same encodings; they are stated here as plain text in the reference's
order.
"""

AGE_RANGES = {
    "0. 49 or younger": (40, 49),
    "1. 50–59": (50, 59),
    "2. 60–69": (60, 69),
    "3. 70–79": (70, 79),
    "4. 80+": (80, 100),
}

ORDINAL_COLUMNS = {
    "glob_hlth_03": ["1. Excellent", "2. Very good", "3. Good", "4. Fair", "5. Poor"],
    "glob_hlth_12": ["1. Excellent", "2. Very good", "3. Good", "4. Fair", "5. Poor"],
    "bmi_03": ["1. Underweight", "2. Normal weight", "3. Overweight", "4. Obese", "5. Morbidly obese"],
    "bmi_12": ["1. Underweight", "2. Normal weight", "3. Overweight", "4. Obese", "5. Morbidly obese"],
    "memory_12": ["1. Excellent", "2. Very good", "3. Good", "4. Fair", "5. Poor"],
    "rrelgimp_03": ["1.very important", "2.somewhat important", "3.not important"],
    "rrelgimp_12": ["1.very important", "2.somewhat important", "3.not important"],
    "satis_ideal_12": ["1. Agrees", "2. Neither agrees nor disagrees", "3. Disagrees"],
    "satis_excel_12": ["1. Agrees", "2. Neither agrees nor disagrees", "3. Disagrees"],
    "satis_fine_12": ["1. Agrees", "2. Neither agrees nor disagrees", "3. Disagrees"],
    "cosas_imp_12": ["1. Agrees", "2. Neither agrees nor disagrees", "3. Disagrees"],
    "wouldnt_change_12": ["1. Agrees", "2. Neither agrees nor disagrees", "3. Disagrees"],
    "decis_personal_12": ["1. A lot", "2. A little", "3. None"],
    "rrfcntx_m_12": ["1.Almost every day", "2.4 or more times a week", "3.2 or 3 times a week", "4.Once a week",
                     "5.2 or 3 times a month", "6.Once a month", "7.Almost Never, sporadic", "8. Never"],
    "rsocact_m_12": ["1.Almost every day", "2.4 or more times a week", "3.2 or 3 times a week", "4.Once a week",
                     "5.2 or 3 times a month", "6.Once a month", "7.Almost Never, sporadic", "8. Never"],
}

EDU_CATEGORIES = {"0. No education": 0, "1. 1–5 years": 2, "2. 6 years": 7, "3. 7–9 years": 8, "4. 10+ years": 10}

LIVING_CHILDREN = {"0. No children": 0, "1. 1 or 2": 1.5, "2. 3 or 4": 3.5, "3. 5 or 6": 5.5, "4. 7+": 7}

CATEGORICAL_COLUMNS = [
    "married_03", "married_12", "urban_03", "urban_12", "employment_03", "employment_12",
    "ragender", "sgender_03", "sgender_12", "rameduc_m", "rafeduc_m", "rjlocc_m_03",
    "rjlocc_m_12", "rrelgwk_12", "a22_12", "a33b_12", "a34_12", "j11_12",
    "rjobend_reason_03", "rjobend_reason_12", "age_03", "age_12", "decis_famil_03", "decis_famil_12",
]

INCOME_COLUMNS = [
    "hincome_03", "hinc_business_03", "hinc_rent_03", "hinc_assets_03", "hinc_cap_03",
    "hincome_12", "hinc_business_12", "hinc_rent_12", "hinc_assets_12", "hinc_cap_12",
]

GROUP_VARS = [
    "edu_gru_12", "narrowed_age_12", "year_participation", "bmi_12", "glob_hlth_12", "reads_12",
    "n_living_child_12", "j11_12_Wood__mosaic__or_other_covering_1", "memory_12", "n_depr_12",
    "games_12", "rrfcntx_m_12", "rsocact_m_12",
]

ACTIVITY_FEATURES = ["care_adult", "care_child", "volunteer", "attends_class", "attends_club",
                     "reads", "games", "table_games", "comms_tel_comp", "act_mant", "tv", "sewing"]
