"""Item keys, name lists, code lists, weights, bands and patterns.

Everything in this module is data, not logic.  The values have to equal the published or site-given
ones for results to be right, so they are written out plainly and in their natural order.
"""

# --- Fixed values: warehouse item keys -----------------------------------------------------------
# name -> item key; A and B are the two sites, whose key spaces differ.

LAB_KEYS_A = {
    "WBC Count": 994, "Hemoglobin": 5345, "Hematocrit": 5346, "RBC Count": 970, "MCV": 950, "MCH": 948,
    "MCHC": 949, "Platelet Count": 967, "POCT, Total Hemoglobin": 32195,
    "Hemoglobin, Plasma, Alternative Method": 21555, "POCT, Total Hemoglobin (Oximetry)": 21968,
    "Abs Eosinophils": 926, "Abs Basophils": 910, "Abs Lymphocytes": 944, "Abs Neutrophils": 959,
    "Abs Monocytes": 955, "Creatinine": 586, "Creatinine (POCT)": 587, "Sodium": 5276, "Potassium": 5274,
    "Calcium": 6110, "Urea Nitrogen": 5238, "Bicarbonate": 569, "Chloride": 5277, "Glucose": 4399,
    "Anion Gap": 563, "AST": 5236, "Alanine transaminase": 5230, "Alkaline Phosphatase": 5229,
    "Bilirubin, Total": 7497, "Bilirubin, Direct": 12120, "Total Protein": 5271, "Albumin": 2444,
    "Lactate, blood": 653, "Lactate, plasma": 5975, "PO2": 683, "PO2, Venous": 25090,
    "eGFR High Estimate": 594, "eGFR Low Estimate": 595, "INR": 759, "aPTT": 2420,
    "Prothrombin Time": 49399, "Fibrinogen, Functional": 6042, "Troponin I": 2467, "Procalcitonin": 25350,
    "CRP": 5993, "Magnesium": 5948, "Phosphorus": 5886, "Calcium, Ionized, whole blood": 573,
    "Calcium, Ionized, Serum/Plasma": 2458, "Hemoglobin A1c": 2469,
}

LAB_KEYS_B = {
    "WBC Count": 2810, "Hemoglobin": 3165, "Hematocrit": 3815, "MCV": 4459, "RBC Count": 2654,
    "MCHC": 4458, "MCH": 4457, "Platelet Count": 6230, "Absolute Neutrophils": 3866,
    "Absolute Basophils": 3173, "Absolute Eosinophils": 3172, "Absolute Lymphocytes": 3170,
    "Absolute Monocytes": 3171, "Absolute Large Lymphocytes": 8192, "Creatinine, Serum": 5744,
    "Potassium": 3097, "Sodium": 3099, "Calcium": 3908, "BUN": 3911, "CO2": 3063, "Chloride": 3100,
    "Glucose, Non Fasting": 2235, "Glucose, Fingerstick": 9989, "Glucose WB": 2581,
    "Anion Gap (No K)": 8181, "ALT": 8176, "AST": 3060, "Alkaline Phosphatase": 3053,
    "Total Bilirubin": 3095, "Bilirubin, Direct": 3941, "Total Protein": 3094, "Albumin, Serum g/dL": 6273,
    "Lactate, Whole Blood": 17901, "Lactate, Venous": 9964, "pO2": 8426, "Venous pO2": 3916,
    "eGFR Low Estimate": 18016, "eGFR High Estimate": 18017, "INR": 8379, "Prothrombin Time": 17997,
    "Activated PTT": 17998, "Fibrinogen": 4173, "Troponin I": 3132, "Troponin I High Sensitivity": 18007,
    "Procalcitonin": 1734, "CRP, High sensitivity": 3873, "Magnesium": 3745, "Phosphorus": 8421,
    "Ionized Calcium": 3909, "Hemoglobin A1C": 3082,
}

ASSESS_KEYS_A = {
    "Weight/Scale": 5106, "Respirations": 39413, "Blood Pressure": 32710, "Temperature": 34432,
    "Pulse": 38524, "Pulse - Palpated or Pleth": 8369, "MAP": 16489, "MAP A-Line": 16478,
    "Art Line BP": 16479, "Art Line BP 2": 16481, "GCS Eye": 8550, "GCS Verbal": 30983, "GCS Motor": 8554,
    "GCS Score": 30984, "GCS Score V2": 105926, "Pain Score": 18412, "Pain Score (Category)": 9258,
    "RASS": 30034,
}

RESP_KEYS_A = {
    "FiO2": 16511, "FiO2 2": 41880, "PEEP/CPAP Set": 28730, "RT Vent Mode": 35186,
    "RT Mode/Breath Type": 34086, "RT Vent RR Total": 36316, "RT MAP Measured": 19958,
    "RT Adult Vent Type": 36279, "RT Minute Volume V2": 41884, "RT Tidal Volume Exhaled": 36317,
    "RT I:E Ratio": 36324, "OSI": 47494, "RR Set": 28738, "O2 Device (ED)": 8653,
    "O2 Delivery Device": 100298, "O2 Delivery Ventilation": 100297, "Pressure Support": 36304,
    "PaO2/FiO2 Ratio": 47495, "EtCO2 (AN)": 2300, "EtCO2 (RT)": 36568, "CPOT": 41883,
}

ASSESS_KEYS_B = {
    "Temp": 29366, "BP": 27705, "SpO2": 2, "Pulse": 33278, "Resp": 33957, "MAP": 18911, "HR-ECG": 1479,
    "Weight/Scale": 9079, "GCS Eye": 14847, "GCS Verbal": 14848, "GCS Motor": 14849, "GCS Score": 14850,
    "GCS Numeric Score": 14855, "Pulse from SpO2": 34185, "MAP A-Line": 18900, "MAP A-Line 2": 24384,
    "Pulse from Art Line": 34223, "Pulse Ox Type": 20691, "RASS": 21357, "ED RASS": 15204,
    "DPH CV RASS": 50318, "Pain Score": 21066, "Pain Score (Category)": 15593, "GCS Trigger": 23619,
    "ED GCS Calculator": 13093, "Art Line BP": 18901, "Art Line BP 2": 18903,
}

RESP_KEYS_B = {
    "O2": 1421, "Vent Mode (AN)": 1427, "etCO2": 1442, "Resp Rate-Vent": 1615, "FiO2": 18934,
    "Vent PEEP": 18942, "Vent Tidal Volume Set": 18938, "Vent Tidal Volume Spont": 24757,
    "Vent I:E Ratio": 26144, "IP Vent Mode": 20251, "PEEP Measured": 32956, "PEEP/CPAP Set": 24764,
    "RR Set": 24772, "Tidal Volume Mech": 33036, "Tidal Volume ML/KG Mech": 33037,
    "Tidal Volume Spont (DPH)": 33079, "Minute Volume Measured": 33038, "Minute Volume Spont": 33081,
    "PaO2/FiO2 Ratio": 33524, "Press Support": 33071, "Oxygen Therapy": 22553, "Vent EtCO2": 18944,
    "Resp Rate EtCO2": 19,
}

# --- Fixed values: cohort criteria ---------------------------------------------------------------

ED_DEPARTMENT_A = "EMERGENCY DEPT PARN"
ED_DEPARTMENT_B = "ED"
WBC_KEYS = [994, 2810]
TEMPERATURE_KEYS = [34432, 29366]
BLOOD_PRESSURE_KEYS = [32710, 27705]
WBC_LOW, WBC_HIGH = 4.0, 12.0
TEMP_LOW, TEMP_HIGH = 36.0, 38.5
SBP_LOW = 90
CBC_HOURS, IMAGING_HOURS, HYPOTENSION_HOURS = 2, 4, 4
MIN_AGE = 18

IMAGING_CATEGORIES = [
    "IMG CT ORDERABLES", "IMG CT PROCEDURES", "IMG DIAGNOSTIC IMAGING ORDERABLES",
    "IMG FILM OVERREAD ORDERABLES", "IMG FILM STORAGE ORDERABLES", "IMG FLUOROSCOPY ORDERABLES",
    "IMG FLUOROSCOPY PROCEDURES", "IMG IR ORDERABLES", "IMG IR PROCEDURES", "IMG MRI ORDERABLES",
    "IMG MRI PROCEDURES", "IMG XR PROCEDURES", "IMG US PROCEDURES", "IMG NM PROCEDURES",
    "IMG DEXA PROCEDURES",
]
LUNG_WORDS = ["chest", "lung"]
ANTIBIOTIC_CLASS = "ANTIBIOTICS"
VASOPRESSOR_NAMES = [
    "NOREPINEPHRINE", "VASOPRESSIN", "EPINEPHRINE", "DOBUTAMINE", "MILRINONE", "PHENYLEPHRINE",
    "DOPAMINE",
]
VASOPRESSOR_ROUTES = ["intravenous", "injection"]
GIVEN_ACTIONS = [
    "Given", "Given During Downtime", "Given by Other", "New Bag", "New Syringe",
    "Started During Downtime",
]

# column candidates, first present wins; (date, time of day) pairs are used when no instant exists
ARRIVAL_INSTANTS = ["arrivalinstant"]
ARRIVAL_PAIRS = [("arrivaldatekeyvalue", "arrivaltimeofdaykeyvalue"), ("arrivaldate", "arrivaltime")]
LAB_INSTANTS = ["resultinstant", "collectioninstant"]
LAB_PAIRS = [
    ("resultdatekeyvalue", "resulttimeofdaykeyvalue"),
    ("collectiondatekeyvalue", "collectiontimeofdaykeyvalue"),
]
LAB_VALUES = ["value", "numericvalue", "resultvalue"]
VITAL_INSTANTS = ["takeninstant", "recordedinstant"]
VITAL_PAIRS = [
    ("takendatekeyvalue", "takentimeofdaykeyvalue"),
    ("recordeddatekeyvalue", "recordedtimeofdaykeyvalue"),
]
VITAL_VALUES = ["value", "numericvalue", "displayvalue"]
BP_VALUES = ["value", "displayvalue"]
IMAGING_INSTANTS = ["orderinginstant", "orderinstant", "examstartinstant", "startinstant"]
IMAGING_PAIRS = [
    ("orderingdatekeyvalue", "orderingtimeofdaykeyvalue"),
    ("orderdatekeyvalue", "ordertimeofdaykeyvalue"),
    ("examstartdatekeyvalue", "examstarttimeofdaykeyvalue"),
    ("startdatekeyvalue", "starttimeofdaykeyvalue"),
]

# --- Fixed values: severity scores ---------------------------------------------------------------
# NEWS2 bands: (upper limit, points) tried in order, then the points above the last limit.

NEWS_RESP = ([(8, 3), (11, 1), (20, 0), (24, 2)], 3)
NEWS_SPO2 = ([(91, 3), (93, 2), (95, 1)], 0)
NEWS_TEMP = ([(35.0, 3), (36.0, 1), (38.0, 0), (39.0, 1)], 2)
NEWS_SBP = ([(90, 3), (100, 2), (110, 1), (219, 0)], 3)
NEWS_PULSE = ([(40, 3), (50, 1), (90, 0), (110, 1), (130, 2)], 3)
NEWS_SPO2_SCALE2 = [(83, 3), (85, 2), (87, 1), (92, 0)]
NEWS_SPO2_SCALE2_ON_OXYGEN = ([(94, 1), (96, 2)], 3)
# a response below the full mark scores 3
GCS_FULL = {"Best Eye Response": 4, "Best Verbal Response": 5, "Best Motor Response (upper extremities)": 6}

VENTILATION_ROWS = ["R RESP PEEP/CPAP SET", "R RT VENT MODE", "R RT MODE/BREATH TYPE"]
ESOFA_LACTATE = ["Lactate, plasma"]
ESOFA_CREATININE = ["Creatinine", "Creatinine, Serum"]
ESOFA_BILIRUBIN = ["Bilirubin, Total"]
ESOFA_PLATELET = ["Platelet Count"]

# label -> names, in output order
EPOCH_LABS = {
    "creatinine": ["Creatinine", "Creatinine, Serum"],
    "lactate": ["Lactate, plasma"],
    "hgb": ["Hemoglobin"],
    "bili": ["Bilirubin, Total"],
    "plt": ["Platelet Count"],
    "wbc": ["WBC Count"],
    "po2": ["PO2"],
}
EPOCH_VITALS = {
    "pulse": ["Pulse", "Pulse - Palpated/Pleth"],
    "resp": ["Resp"],
    "temp": ["Temp"],
    "map": ["MAP (mmHg)", "Arterial Line MAP (mmHg)", "BP"],
    "gcs_eye": ["Best Eye Response"],
    "gcs_verbal": ["Best Verbal Response"],
    "gcs_motor": ["Best Motor Response (upper extremities)"],
    "weight": ["Weight"],
}

# text that stands for "no value"
UNKNOWN_TEXT = "(?i)Unknown|Decline"
BLANK_TEXT = r"^\*|^$|^Missing$"

# --- Fixed values: summary words -----------------------------------------------------------------

SEPSIS_WORDS = ["sepsis", "septic", "bacteremia", "septicemia"]
LUNG_DX_WORDS = ["pneumonia", "pneumonitis", "lung infection", "respiratory"]
# marker -> words in order of preference
LAB_MARKERS = {
    "lactate": ["lactate", "lactic"],
    "WBC": ["wbc", "white blood cell", "leukocyte"],
    "creatinine": ["creatinine", "creat"],
    "procalcitonin": ["procalcitonin", "pct"],
    "CRP": ["c-reactive protein", "crp"],
    "blood culture": ["blood culture"],
}

# --- Fixed values: ICU department words ----------------------------------------------------------

ICU_WORDS = [
    "ICU", "ICC", "INTENSIVE CARE", "CRITICAL CARE", "MICU", "SICU", "PICU", "NICU", "CCU", "CVICU",
    "BURN UNIT", "NEURO ICU", "CARDIAC ICU",
]

# --- Fixed values: sepsis-related diagnosis classes ----------------------------------------------
# code prefixes and name words per class

DX_EXCLUDED_CODES = ["Z", "N18", "N19"]
DX_SEPSIS_CODES = ["A40", "A41", "R65.2", "R65.1", "R78.81"]
DX_SEPSIS_WORDS = ["SEPSIS", "SEPTIC", "BACTEREMIA", "FUNGEMIA"]
DX_RESPIRATORY_CODES = [
    "J09", "J10", "J11", "J12", "J13", "J14", "J15", "J16", "J17", "J18", "J20", "J21", "J22", "J85",
    "J86",
]
DX_URINARY_CODES = ["N10", "N30.0", "N30.8", "N30.9", "N39.0"]
DX_URINARY_WORDS = ["PYELONEPHRITIS", "URINARY TRACT INFECTION"]
DX_ABDOMINAL_CODES = [
    "K65", "K35", "K57.0", "K57.2", "K57.4", "K57.8", "K61", "K63.0", "K81.0", "K83.0",
]
DX_ABDOMINAL_WORDS = ["PERITONITIS", "CHOLANGITIS", "APPENDICITIS", "DIVERTICULITIS"]
DX_SKIN_CODES = ["L00", "L01", "L02", "L03", "L04", "L05.0", "L08", "M72.6"]
DX_SKIN_WORDS = ["CELLULITIS", "NECROTIZING FASCIITIS"]
DX_VASCULAR_CODES = ["I70", "I73"]
DX_NONBACTERIAL_CODES = ["G03.0"]
DX_OTHER_CODES = [
    "A00", "A01", "A02", "A03", "A04", "A05", "A20", "A21", "A22", "A23", "A24", "A25", "A26", "A27",
    "A28", "A30", "A31", "A32", "A33", "A34", "A35", "A36", "A37", "A38", "A39", "A42", "A43", "A44",
    "A46", "A48", "A49", "G00", "G01", "G02", "G03", "G04", "G05", "G06", "M00", "M86.0", "M86.1",
    "M86.2", "I30.1", "I33", "I40.0", "T80.2", "T82.6", "T82.7", "T83.5", "T83.6", "T84.5", "T84.6",
    "T84.7", "T85.7",
]
DX_OTHER_WORDS = ["MENINGITIS", "ENCEPHALITIS", "ENDOCARDITIS", "OSTEOMYELITIS"]
DX_SHOCK_CODES = ["R57"]
DX_ORGAN_CODES = ["N17", "J96.0", "J96.9", "J80", "K72.0", "K72.9", "D65", "G93.4"]
DX_ORGAN_EXACT_CODES = ["R41.82", "E87.2"]
DX_ORGAN_WORDS = [
    "ACUTE KIDNEY", "ACUTE RENAL FAILURE", "ACUTE RESPIRATORY FAILURE", "ACUTE HEPATIC",
    "ACUTE LIVER FAILURE", "DISSEMINATED INTRAVASCULAR", "LACTIC ACIDOSIS",
]
DX_ORGAN_WHOLE_WORDS = ["DIC", "ARDS"]
DX_FEVER_CODES = ["R50"]

# --- Fixed values: clinical concept -> raw variable names ----------------------------------------

CONCEPTS = {
    "Respirations": ["RESPIRATIONS"],
    "Pulse": ["PULSE"],
    "Blood Pressure": ["BLOOD PRESSURE"],
    "Temperature": ["TEMPERATURE"],
    "MAP": ["R MAP"],
    "MAP (A-Line)": ["R MAP A-LINE", "R MAP A-LINE 2"],
    "MAP (Measured)": ["RT MAP MEASURED", "RT MAP MEASURED_IP_CD_UCSF"],
    "Arterial Line BP": ["R ARTERIAL LINE BLOOD PRESSURE", "R ARTERIAL LINE BLOOD PRESSURE 2"],
    "Pulse Oximetry": ["PULSE OXIMETRY", "PULSE - PALPATED OR PLETH", "R ZSFG PULSE FROM SPO2",
        "R ZSFG PULSE FROM ART LINE", "R PULSE OXIMETRY TYPE"],
    "Weight": ["WEIGHT/SCALE"],
    "GCS - Eye": ["R CPN ADULT GLASGOW COMA SCALE EYE OPENING", "R DPH ED GCS ADULT BEST EYE RESPONSE"],
    "GCS - Verbal": ["R CPN ADULT GLASGOW COMA SCALE BEST VERBAL RESPONSE",
        "R DPH ED GCS ADULT BEST VERBAL RESPONSE"],
    "GCS - Motor": ["R CPN GLASGOW COMA SCALE BEST MOTOR RESPONSE",
        "R DPH ED GCS ADULT BEST MOTOR RESPONSE"],
    "GCS - Score": ["R CPN GLASGOW COMA SCALE SCORE", "R CPN GLASGOW COMA SCALE SCORE V2",
        "R DPH ED GCS ADULT SCORE", "R DPH ED GCS NUMERIC SCORE",
        "ZSFG R ADULT OR PEDIATIRC GCS TRIGGER ROW?",
        "R ED CLINICAL CALCULATOR - GLASGOW COMA SCALE SCORE"],
    "RASS": ["R RICHMOND AGITATION SEDATION SCALE (RASS)", "R RICHMOND AGITATION SEDATION SCALE",
        "ED RASS", "DPH CV RASS"],
    "Pain Score": ["DPH R PAIN SCORE", "R IP PAIN SCORE", "PAIN SCORE (CATEGORY LIST)",
        "R PATIENT ENTERED PAIN SCORE (CATEGORY LIST)"],
    "FiO2": ["R FIO2 (%)", "R FIO2", "R FIO2 2"],
    "O2 Therapy": ["R OXYGEN THERAPY", "ED R O2 DEVICE", "UCSF R AN O2 DELIVERY DEVICE",
        "UCSF R AN O2 DELIVERY VENTILATION"],
    "PEEP": ["R RESP PEEP/CPAP SET", "R VENT PEEP", "R DPH RT PEEP MEASURED"],
    "Vent Mode": ["R RT VENT MODE", "R RT MODE/BREATH TYPE", "R RT (ADULT) VENT TYPE", "R IP VENT MODE",
        "R AN VENT MODE"],
    "Vent RR": ["R RT VENTILATOR RESPIRATORY RATE  TOTAL", "R RESP RR SET"],
    "Tidal Volume": ["R RT (ADULT) VENTILATOR TIDAL VOLUME EXHALED", "R VENT TIDAL VOLUME SET",
        "R VENT TIDAL VOLUME SPONT", "R DPH TIDAL VOLUME MECH", "R DPH TIDAL VOLUME ML/KG MECH",
        "R DPH RT TIDAL VOLUME SPONT"],
    "Minute Volume": ["R RT VENTILATOR MINUTE VOLUME MEASURED V2", "R DPH MINUTE VOLUME MEASURED",
        "R DPH MINUTE VOLUME SPONT"],
    "I:E Ratio": ["R RT (ADULT) VENTILATOR I:E RATIO MEASURED", "R VENT I:E RATIO"],
    "PaO2/FiO2 Ratio": ["R DPH RT PAO2/FIO2 RATIO", "R PAO2/FIO2 RATIO"],
    "Pressure Support": ["R DPH PRESS SUPPORTABOVEPEEP", "R RT VENTILATOR PRESSURE SUPPORT"],
    "OSI": ["R OXYGEN SATURATION INDEX (OSI)"],
    "EtCO2": ["R AN ETCO2", "UCSF R ANE END TIDAL CO2", "R RT ETCO2", "R VENT ETCO2"],
    "Resp Rate EtCO2": ["R ZSFG RESP RATE ETCO2"],
    "CPOT": ["R CPOT VENT OR VOCAL COMPLIANCE IP_CD_UCSF"],
    "WBC": ["WBC Count"],
    "Hemoglobin": ["Hemoglobin", "POCT, Total Hemoglobin", "Total Hemoglobin",
        "Hemoglobin, Plasma, Alternative Method"],
    "Platelet Count": ["Platelet Count"],
    "Creatinine": ["Creatinine", "Creatinine, Serum", "Creatinine (POCT)", "Creatinine,Whole Blood"],
    "BUN": ["BUN", "Urea Nitrogen", "Urea Nitrogen, serum/plasma"],
    "Sodium": ["Sodium", "Sodium, Serum / Plasma"],
    "Potassium": ["Potassium", "Potassium, Serum / Plasma"],
    "Calcium": ["Calcium", "Calcium, total, Serum / Plasma"],
    "Ionized Calcium": ["Ionized Calcium", "Ionized Calcium, whole blood",
        "Calcium, Ionized, whole blood", "Calcium, Ionized, Serum/Plasma"],
    "Chloride": ["Chloride", "Chloride, Serum / Plasma"],
    "CO2 (Bicarb)": ["CO2", "Bicarbonate"],
    "Glucose": ["Glucose, Non Fasting", "Glucose, Fingerstick", "Glucose WB", "Glucose",
        "Glucose, non-fasting"],
    "Anion Gap": ["Anion Gap (No K)", "Anion Gap"],
    "Lactate": ["Lactate, whole blood", "Lactate, plasma", "Lactate, Whole Blood", "Lactate, Venous"],
    "PO2": ["PO2", "pO2", "PO2, Venous", "Venous pO2"],
    "Bilirubin (Total)": ["Bilirubin, Total", "Total Bilirubin"],
    "Bilirubin (Direct)": ["Bilirubin, Direct"],
    "AST": ["AST"],
    "ALT": ["ALT", "Alanine transaminase"],
    "Alkaline Phosphatase": ["Alkaline Phosphatase"],
    "Total Protein": ["Total Protein", "Protein, Total, Serum / Plasma"],
    "Albumin": ["Albumin", "Albumin, Serum g/dL", "Albumin, Serum / Plasma"],
    "eGFR": ["eGFR Low Estimate", "eGFR High Estimate", "eGFR - low estimate", "eGFR - high estimate"],
    "Hemoglobin A1C": ["Hemoglobin A1C", "Hemoglobin A1c"],
    "Hematocrit": ["Hematocrit"],
    "MCV": ["MCV"],
    "RBC Count": ["RBC Count"],
    "MCHC": ["MCHC"],
    "MCH": ["MCH"],
    "Absolute Neutrophils": ["Absolute Neutrophils", "Abs Neutrophils"],
    "Absolute Basophils": ["Absolute Basophils", "Abs Basophils"],
    "Absolute Eosinophils": ["Absolute Eosinophils", "Abs Eosinophils"],
    "Absolute Lymphocytes": ["Absolute Lymphocytes", "Abs Lymphocytes"],
    "Absolute Monocytes": ["Absolute Monocytes", "Abs Monocytes"],
    "Absolute Large Lymphocytes": ["Absolute Large Lymphocytes"],
    "INR": ["INR"],
    "Prothrombin Time": ["Prothrombin Time"],
    "Activated PTT": ["Activated PTT", "aPTT"],
    "Fibrinogen": ["Fibrinogen", "Fibrinogen, Functional"],
    "Troponin I": ["Troponin I", "Troponin I High Sensitivity (NG/L)"],
    "Procalcitonin": ["Procalcitonin"],
    "CRP": ["CRP,  High sensitivity", "C-Reactive Protein"],
    "Magnesium": ["Magnesium", "Magnesium, Serum / Plasma"],
    "Phosphorus": ["Phosphorus", "Phosphorus, serum/plasma"],
}

# --- Fixed values: comorbidity groupers ----------------------------------------------------------

# refined Elixhauser source categories that count only with present-on-admission evidence
AHRQ_POA_DEPENDENT = [
    "ANEMDEF", "BLDLOSS", "CBVD_POA", "COAG", "HF", "LIVER_MLD", "LIVER_SEV", "NEURO_MOVT",
    "NEURO_OTH", "NEURO_SEIZ", "PARALYSIS", "PSYCHOSES", "PULMCIRC", "RENLFL_MOD", "RENLFL_SEV",
    "ULCER_PEPTIC", "VALVE", "WGHTLOSS",
]
AHRQ_MERGED = {"CBVD_POA": "CBVD", "CBVD_SQLA": "CBVD"}

# Quan et al. 2005, Med Care 43(11):1130-9: ICD-10 code prefixes per category, without dots
QUAN_CODES = {
    "chf": [
        "I099", "I110", "I130", "I132", "I255", "I420", "I425", "I426", "I427", "I428", "I429", "I43", "I50",
        "P290",
    ],
    "carit": [
        "I441", "I442", "I443", "I456", "I459", "I47", "I48", "I49", "R000", "R001", "R008", "T821", "Z450",
        "Z950",
    ],
    "valv": [
        "A520", "I05", "I06", "I07", "I08", "I091", "I098", "I34", "I35", "I36", "I37", "I38", "I39", "Q230",
        "Q231", "Q232", "Q233", "Z952", "Z953", "Z954",
    ],
    "pcd": [
        "I26", "I27", "I280", "I288", "I289",
    ],
    "pvd": [
        "I70", "I71", "I731", "I738", "I739", "I771", "I790", "I792", "K551", "K558", "K559", "Z958", "Z959",
    ],
    "hypunc": [
        "I10",
    ],
    "hypc": [
        "I11", "I12", "I13", "I15",
    ],
    "para": [
        "G041", "G114", "G801", "G802", "G81", "G82", "G830", "G831", "G832", "G833", "G834", "G839",
    ],
    "ond": [
        "G10", "G11", "G12", "G13", "G20", "G21", "G22", "G254", "G255", "G312", "G318", "G319", "G32",
        "G35", "G36", "G37", "G40", "G41", "G931", "G934", "R470", "R56",
    ],
    "cpd": [
        "I278", "I279", "J40", "J41", "J42", "J43", "J44", "J45", "J46", "J47", "J60", "J61", "J62", "J63",
        "J64", "J65", "J66", "J67", "J684", "J701", "J703",
    ],
    "diabunc": [
        "E100", "E101", "E109", "E110", "E111", "E119", "E120", "E121", "E129", "E130", "E131", "E139",
        "E140", "E141", "E149",
    ],
    "diabc": [
        "E102", "E103", "E104", "E105", "E106", "E107", "E108", "E112", "E113", "E114", "E115", "E116",
        "E117", "E118", "E122", "E123", "E124", "E125", "E126", "E127", "E128", "E132", "E133", "E134",
        "E135", "E136", "E137", "E138", "E142", "E143", "E144", "E145", "E146", "E147", "E148",
    ],
    "hypothy": [
        "E00", "E01", "E02", "E03", "E890",
    ],
    "rf": [
        "I120", "I131", "N18", "N19", "N250", "Z490", "Z491", "Z492", "Z940", "Z992",
    ],
    "ld": [
        "B18", "I85", "I864", "I982", "K70", "K711", "K713", "K714", "K715", "K717", "K72", "K73", "K74",
        "K760", "K762", "K763", "K764", "K765", "K766", "K767", "K768", "K769", "Z944",
    ],
    "pud": [
        "K257", "K259", "K267", "K269", "K277", "K279", "K287", "K289",
    ],
    "aids": [
        "B20", "B21", "B22", "B24",
    ],
    "lymph": [
        "C81", "C82", "C83", "C84", "C85", "C88", "C96", "C900", "C902",
    ],
    "metacanc": [
        "C77", "C78", "C79", "C80",
    ],
    "solidtum": [
        "C00", "C01", "C02", "C03", "C04", "C05", "C06", "C07", "C08", "C09", "C10", "C11", "C12", "C13",
        "C14", "C15", "C16", "C17", "C18", "C19", "C20", "C21", "C22", "C23", "C24", "C25", "C26", "C30",
        "C31", "C32", "C33", "C34", "C37", "C38", "C39", "C40", "C41", "C43", "C45", "C46", "C47", "C48",
        "C49", "C50", "C51", "C52", "C53", "C54", "C55", "C56", "C57", "C58", "C60", "C61", "C62", "C63",
        "C64", "C65", "C66", "C67", "C68", "C69", "C70", "C71", "C72", "C73", "C74", "C75", "C76", "C97",
    ],
    "rheumd": [
        "L940", "L941", "L943", "M05", "M06", "M08", "M120", "M123", "M30", "M310", "M311", "M312", "M313",
        "M32", "M33", "M34", "M35", "M45", "M461", "M468", "M469",
    ],
    "coag": [
        "D65", "D66", "D67", "D68", "D691", "D693", "D694", "D695", "D696",
    ],
    "obes": [
        "E66",
    ],
    "wloss": [
        "E40", "E41", "E42", "E43", "E44", "E45", "E46", "R634", "R64",
    ],
    "fed": [
        "E222", "E86", "E87",
    ],
    "blane": [
        "D500",
    ],
    "dane": [
        "D508", "D509", "D51", "D52", "D53",
    ],
    "alcohol": [
        "F10", "E52", "G621", "I426", "K292", "K700", "K703", "K709", "T51", "Z502", "Z714", "Z721",
    ],
    "drug": [
        "F11", "F12", "F13", "F14", "F15", "F16", "F18", "F19", "Z715", "Z722",
    ],
    "psycho": [
        "F20", "F22", "F23", "F24", "F25", "F28", "F29", "F302", "F312", "F315",
    ],
    "depre": [
        "F204", "F313", "F314", "F315", "F32", "F33", "F341", "F412", "F432",
    ],
}
# categories that count without present-on-admission evidence
QUAN_POA_EXEMPT = [
    "aids", "alcohol", "diabunc", "diabc", "hypothy", "hypunc", "hypc", "cpd", "obes", "drug", "psycho",
    "depre", "lymph", "metacanc", "solidtum", "para", "pvd",
]

# van Walraven et al. 2009, Med Care 47(6):626-33
VW_WEIGHTS_QUAN = {
    "chf": 7, "carit": 5, "valv": -1, "pcd": 4, "pvd": 2, "hypunc": 0, "hypc": 0, "para": 7, "ond": 6,
    "cpd": 3, "diabunc": 0, "diabc": 0, "hypothy": 0, "rf": 5, "ld": 11, "pud": 0, "aids": 0, "lymph": 9,
    "metacanc": 12, "solidtum": 4, "rheumd": 0, "coag": 3, "obes": -4, "wloss": 6, "fed": 5, "blane": -2,
    "dane": -2, "alcohol": 0, "drug": -7, "psycho": 0, "depre": -3,
}

VW_WEIGHTS_AHRQ = {
    "AIDS": 0, "ALCOHOL": 0, "ANEMDEF": -2, "AUTOIMMUNE": 0, "BLDLOSS": -2, "CANCER_LEUK": 9,
    "CANCER_LYMPH": 9, "CANCER_METS": 12, "CANCER_NSITU": 4, "CANCER_SOLID": 4, "CBVD": 0, "COAG": 3,
    "DEMENTIA": 0, "DEPRESS": -3, "DIAB_CX": 0, "DIAB_UNCX": 0, "DRUG_ABUSE": -7, "HF": 7, "HTN_CX": 0,
    "HTN_UNCX": 0, "LIVER_MLD": 11, "LIVER_SEV": 11, "LUNG_CHRONIC": 3, "NEURO_MOVT": 6, "NEURO_OTH": 6,
    "NEURO_SEIZ": 6, "OBESE": -4, "PARALYSIS": 7, "PERIVASC": 2, "PSYCHOSES": 0, "PULMCIRC": 4,
    "RENLFL_MOD": 5, "RENLFL_SEV": 5, "THYROID_HYPO": 0, "THYROID_OTH": 0, "ULCER_PEPTIC": 0, "VALVE": -1,
    "WGHTLOSS": 6,
}

# HCC version 28: payment categories
HCC_NUMBERS = [
    1, 2, 6, 17, 18, 19, 20, 21, 22, 23, 35, 36, 37, 38, 48, 49, 50, 51, 62, 63, 64, 65, 68, 77, 78, 79,
    80, 81, 92, 93, 94, 107, 108, 109, 111, 112, 114, 115, 125, 126, 127, 135, 136, 137, 138, 139, 151,
    152, 153, 154, 155, 180, 181, 182, 190, 191, 192, 193, 195, 196, 197, 198, 199, 200, 201, 202, 211,
    212, 213, 221, 222, 223, 224, 225, 226, 227, 228, 229, 238, 248, 249, 253, 254, 263, 264, 267, 276,
    277, 278, 279, 280, 282, 283, 298, 300, 326, 327, 328, 329, 379, 380, 381, 382, 383, 385, 387, 397,
    398, 399, 401, 402, 405, 409, 454, 463,
]

# HCC version 28: (parent, categories it sets to zero), to be applied in this order
HCC_HIERARCHY = [
    (17, [18, 19, 20, 21, 22, 23]),
    (18, [19, 20, 21, 22, 23]),
    (19, [20, 21, 22, 23]),
    (20, [21, 22, 23]),
    (21, [22, 23]),
    (22, [23]),
    (35, [36, 37, 38]),
    (36, [37, 38]),
    (37, [38]),
    (62, [63, 64, 65, 68]),
    (63, [64, 65, 68, 202]),
    (64, [65, 68]),
    (77, [78, 80, 81]),
    (80, [81]),
    (93, [94]),
    (107, [108]),
    (111, [112]),
    (114, [115]),
    (125, [126, 127]),
    (126, [127]),
    (135, [136, 137, 138, 139]),
    (136, [137, 138, 139]),
    (137, [138, 139]),
    (138, [139]),
    (151, [152, 153, 154, 155]),
    (152, [153, 154, 155]),
    (153, [154, 155]),
    (154, [155]),
    (180, [181, 182, 253, 254]),
    (181, [182, 254]),
    (191, [180, 181, 182, 192, 253, 254]),
    (192, [180, 181, 182, 253, 254]),
    (195, [196]),
    (211, [212, 213]),
    (212, [213]),
    (221, [222, 223, 224, 225, 226, 227]),
    (222, [223, 224, 225, 226, 227]),
    (223, [224, 225, 226, 227]),
    (224, [225, 226, 227]),
    (225, [226, 227]),
    (226, [227]),
    (228, [229]),
    (248, [249]),
    (253, [254]),
    (263, [264, 383, 409]),
    (276, [277, 278, 279, 280]),
    (277, [278, 279, 280]),
    (278, [279, 280]),
    (279, [280]),
    (282, [283]),
    (326, [327, 328, 329]),
    (327, [328, 329]),
    (328, [329]),
    (379, [380, 381, 382, 383]),
    (380, [381, 382, 383]),
    (381, [382, 383]),
    (382, [383]),
    (397, [202, 398, 399]),
    (398, [202, 399]),
    (405, [409]),
]

# HCC version 28: diagnostic groups and the products of two groups
HCC_GROUPS = {
    "CANCER_V28": [17, 18, 19, 20, 21, 22, 23],
    "DIABETES_V28": [35, 36, 37, 38],
    "CARD_RESP_FAIL": [211, 212, 213],
    "HF_V28": [221, 222, 223, 224, 225, 226],
    "CHR_LUNG_V28": [276, 277, 278, 279, 280],
    "KIDNEY_V28": [326, 327, 328, 329],
    "SEPSIS": [2],
    "gSubUseDisorder_V28": [135, 136, 137, 138, 139],
    "gPsychiatric_V28": [151, 152, 153, 154, 155],
    "NEURO_V28": [180, 181, 182, 190, 191, 192, 195, 196, 198, 199],
    "ULCER_V28": [379, 380, 381, 382],
    "HCC238": [238],
}
HCC_INTERACTIONS = {
    "DIABETES_HF_V28": ("DIABETES_V28", "HF_V28"),
    "HF_CHR_LUNG_V28": ("HF_V28", "CHR_LUNG_V28"),
    "HF_KIDNEY_V28": ("HF_V28", "KIDNEY_V28"),
    "CHR_LUNG_CARD_RESP_FAIL_V28": ("CHR_LUNG_V28", "CARD_RESP_FAIL"),
    "HF_HCC238_V28": ("HF_V28", "HCC238"),
}
HCC_DISABLED_COMMUNITY_INTERACTIONS = {
    "gSubUseDisorder_gPsych_V28": ("gSubUseDisorder_V28", "gPsychiatric_V28"),
}
# products with the disability flag
HCC_DISABLED_INTERACTIONS = {
    "DISABLED_CANCER_V28": "CANCER_V28",
    "DISABLED_NEURO_V28": "NEURO_V28",
    "DISABLED_HF_V28": "HF_V28",
    "DISABLED_CHR_LUNG_V28": "CHR_LUNG_V28",
    "DISABLED_ULCER_V28": "ULCER_V28",
}
HCC_HEART_PATCH = (223, [221, 222, 224, 225, 226])

# age and sex edits: code lists without dots
EDIT_FEMALE_CODES, EDIT_FEMALE_CC = ["D66", "D67"], 112
EDIT_LUNG_CODES, EDIT_LUNG_UNDER_AGE = [
    "J410", "J411", "J418", "J42", "J430", "J431", "J432", "J438", "J439", "J440", "J441", "J449",
    "J982", "J983", "J4481", "J4489",
], 18
EDIT_BREAST_CODES, EDIT_BREAST_UNDER_AGE, EDIT_BREAST_CC = [
    "C50011", "C50012", "C50019", "C50021", "C50022", "C50029", "C50111", "C50112", "C50119", "C50121",
    "C50122", "C50129", "C50211", "C50212", "C50219", "C50221", "C50222", "C50229", "C50311", "C50312",
    "C50319", "C50321", "C50322", "C50329", "C50411", "C50412", "C50419", "C50421", "C50422", "C50429",
    "C50511", "C50512", "C50519", "C50521", "C50522", "C50529", "C50611", "C50612", "C50619", "C50621",
    "C50622", "C50629", "C50811", "C50812", "C50819", "C50821", "C50822", "C50829", "C50911", "C50912",
    "C50919", "C50921", "C50922", "C50929", "C50A0", "C50A1", "C50A2",
], 50, 22
EDIT_NEWBORN_CODES, EDIT_NEWBORN_FROM_AGE = [
    "P040", "P041", "P0411", "P0412", "P0413", "P0414", "P0415", "P0416", "P0417", "P0418", "P0419",
    "P041A", "P042", "P043", "P0440", "P0441", "P0442", "P0449", "P045", "P046", "P048", "P0481",
    "P0489", "P049", "P270", "P271", "P278", "P279", "P930", "P938", "P961", "P962",
], 2

# age cells: (label, first age); each cell ends where the next begins
AGE_CELLS = [
    ("0_34", 0), ("35_44", 35), ("45_54", 45), ("55_59", 55), ("60_64", 60), ("65_69", 65), ("70_74", 70),
    ("75_79", 75), ("80_84", 80), ("85_89", 85), ("90_94", 90), ("95_GT", 95),
]
AGE_CELLS_NEW_ENROLLEE = [
    ("0_34", 0), ("35_44", 35), ("45_54", 45), ("55_59", 55), ("60_64", 60), ("65", 65), ("66", 66),
    ("67", 67), ("68", 68), ("69", 69), ("70_74", 70), ("75_79", 75), ("80_84", 80), ("85_89", 85),
    ("90_94", 90), ("95_GT", 95),
]
# score name -> (coefficient prefix, model)
HCC_SEGMENTS = {
    "SCORE_COMMUNITY_NA": ("CNA", "community_aged"),
    "SCORE_COMMUNITY_ND": ("CND", "community_disabled"),
    "SCORE_COMMUNITY_FBA": ("CFA", "community_aged"),
    "SCORE_COMMUNITY_FBD": ("CFD", "community_disabled"),
    "SCORE_COMMUNITY_PBA": ("CPA", "community_aged"),
    "SCORE_COMMUNITY_PBD": ("CPD", "community_disabled"),
    "SCORE_INSTITUTIONAL": ("INS", "institutional"),
    "SCORE_NEW_ENROLLEE": ("NE", "new_enrollee"),
    "SCORE_SNP_NEW_ENROLLEE": ("SNPNE", "new_enrollee"),
}

CCSR_SYSTEMS = {
    "BLD": "Blood", "CIR": "Circulatory", "DEN": "Dental", "DIG": "Digestive", "EAR": "Ear",
    "END": "Endocrine", "EXT": "External Causes", "EYE": "Eye", "FAC": "Factors Influencing Health",
    "GEN": "Genitourinary", "INF": "Infectious", "INJ": "Injury", "MAL": "Malformations",
    "MBD": "Mental/Behavioral", "MUS": "Musculoskeletal", "NEO": "Neoplasms", "NVS": "Nervous System",
    "PNL": "Perinatal", "PRG": "Pregnancy", "RSP": "Respiratory", "SKN": "Skin", "SYM": "Symptoms/Signs",
}
POA_TYPES = ["Medical History", "Problem List"]

# a hierarchy rule in the published macro text: parent, then children
HIERARCHY_RULE = r"%SET0\s*\(\s*CC\s*=\s*(\d+)\s*,\s*HIER\s*=\s*%STR\(([^)]+)\)\s*\)"
# a word that rules out one that comes after it
RULED_OUT = r"WITHOUT\b.*\b"

# --- Fixed values: HCC label text ----------------------------------------------------------------
# Number and description of a category in a label text.

HCC_LABEL_PATTERN = r'\bHCC(\d+)\s*=\s*"([^"]+)"'
