"""Codes, word lists and limits of the two source databases."""

from __future__ import annotations

from wardline.functions.recode import Concept
from wardline.operators.transform import Transforms

# --- Fixed values: oxygen devices and ventilator modes of the first database ---------------

TRACHEOSTOMY = ["Tracheostomy tube", "Trach mask "]
INTUBATED = ["Endotracheal tube"]
NONINVASIVE = ["Bipap mask ", "CPAP mask "]
HIGH_FLOW = ["High flow nasal cannula"]
NON_REBREATHER = ["Non-rebreather"]
OTHER_OXYGEN = [
    "Face tent", "Aerosol-cool", "Venti mask ", "Medium conc mask ", "Ultrasonic neb", "Vapomist",
    "Oxymizer", "High flow neb",
]
NASAL_PRONGS = ["Nasal cannula"]
NO_DEVICE = ["None"]
VENTILATOR_MODES = [
    "(S) CMV", "APRV", "APRV/Biphasic+ApnPress", "APRV/Biphasic+ApnVol", "APV (cmv)", "Ambient",
    "Apnea Ventilation", "CMV", "CMV/ASSIST", "CMV/ASSIST/AutoFlow", "CMV/AutoFlow", "CPAP/PPS",
    "CPAP/PSV+Apn TCPL", "CPAP/PSV+ApnPres", "CPAP/PSV+ApnVol", "MMV", "MMV/AutoFlow", "MMV/PSV",
    "MMV/PSV/AutoFlow", "P-CMV", "PCV+", "PCV+/PSV", "PCV+Assist", "PRES/AC", "PRVC/AC", "PRVC/SIMV",
    "PSV/SBT", "SIMV", "SIMV/AutoFlow", "SIMV/PRES", "SIMV/PSV", "SIMV/PSV/AutoFlow", "SIMV/VOL",
    "SYNCHRON MASTER", "SYNCHRON SLAVE", "VOL/AC",
]
HAMILTON_INVASIVE = [
    "APRV", "APV (cmv)", "Ambient", "(S) CMV", "P-CMV", "SIMV", "APV (simv)", "P-SIMV", "VS", "ASV",
]
HAMILTON_NONINVASIVE = ["DuoPaP", "NIV", "NIV-ST"]
FLOW_DEVICES = [
    "Non-rebreather", "Nasal cannula", "Face tent", "Aerosol-cool", "Venti mask ", "Medium conc mask ",
    "Ultrasonic neb", "Vapomist", "Oxymizer",
]
INTUBATION_PROCEDURE = 224385
CHARTED_FIO2 = 223835
CODE_STATUS = 228687
CODE_STATUS_LIMITED = [
    "Comfort measures only", "DNAR (Do Not Attempt Resuscitation) [DNR] / DNI",
]
CODE_STATUS_FULL = ["Full code", "DNAR (Do Not Attempt Resuscitation)  [DNR]"]
PLANNED_ADMISSIONS = ["SURGICAL SAME DAY ADMISSION", "ELECTIVE"]
GIVEN = ["Administered", "Started"]
ARTERIAL = "ART."
DIED = "DIED"

# --- Fixed values: charted items of the first database -----------------------------------------

EFFORT_SIGNS = {
    229322: {
        1: [
            "Agonal", "Discoordinate", "Gasping efforts", "Prolonged exhalation", "Shallow", "Irregular",
            "Nasal flaring", "Cheyne-Stokes", "Accessory muscle use/retractions",
            "Frequent desaturation episodes", "Inability to speak in full sentences", "Active exhalation",
        ],
        0: ["Regular"],
    },
    223990: {1: ["Dyspneic", "Agonal", "Labored", "Shallow", "Apneic"], 0: ["Normal"]},
    229323: {
        1: [
            "Moderate - 4", "Moderate - 5", "Moderate - 6", "Moderate - 7", "Severe - 8", "Severe - 9",
            "Severe - 10",
        ],
        0: ["None - 0", "Mild - 1", "Mild - 2", "Mild - 3"],
    },
}
CHARTED = [
    *[Concept(c, "resp_rate", 0, 70) for c in (220210, 224690)],
    Concept(220277, "spo2", 0, 100, high_closed=True),
    Concept(220045, "heart_rate", 0, 300),
    *[Concept(c, "sbp", 0, 400) for c in (220179, 220050)],
    *[Concept(c, "dbp", 0, 400) for c in (220180, 220051)],
    *[Concept(c, "mbp", 0, 400) for c in (220052, 220181, 225312)],
    Concept(223900, "GCS_verbal"),
    Concept(223901, "GCS_motor"),
    Concept(220739, "GCS_eyes"),
    *[
        Concept(item, "wob", text=text, constant=sign)
        for item, signs in EFFORT_SIGNS.items()
        for sign, texts in signs.items()
        for text in texts
    ],
    Concept(223761, "temperature", 70, 120, scale=1 / 1.8, offset=-32 / 1.8),
    Concept(223762, "temperature", 10, 50),
]
LABS = [
    Concept(50818, "pco2", 0), Concept(50820, "ph", 0), Concept(50813, "lactate", 0),
    Concept(51222, "hb", 0), Concept(51301, "wbc", 0), Concept(51265, "plt", 0), Concept(50912, "cr", 0),
    Concept(50882, "bicarb", 0), Concept(51003, "trop", 0), Concept(50861, "alt", 0),
    Concept(50885, "bili", 0), Concept(50862, "albumin", 0), Concept(50931, "glucose", 0),
]
PROCEDURES = {225459: "cxr", 229581: "cxr", 225752: "aline", 224263: "cvc", 229351: "Foley"}
PRESSORS = ["norepinephrine", "vasopressin", "dopamine", "phenylephrine", "epinephrine"]

# --- Fixed values: drug names, in order of precedence ----------------------------------------------
# Only names that pass both the filter and the classification of the source study.

DRUG_CLASSES = [
    ("lasix", ["furosemide"]),
    ("puffer", ["albuterol"]),
    ("benzo", ["lorazepam", "ativan", "clonazepam", "diazepam"]),
    ("opioid", ["fentanyl", "hydromorphone", "hydrocodone", "oxycodone", "morphine"]),
    (
        "antipsych",
        [
            "aripiprazole", "clozapine", "droperidol", "haloperidol", "loxapine", "olanzapine",
            "quetiapine", "risperidone",
        ],
    ),
    (
        "abx",
        [
            "adoxa", "ala-tet", "alodox", "amikacin", "amikin", "amoxicill", "ancef", "clavulanate",
            "ampicillin", "augmentin", "avelox", "avidoxy", "azactam", "azithromycin", "aztreonam", "axetil",
            "bactocill", "bactrim", "bactroban", "bethkis", "biaxin", "bicillin l-a", "cayston", "cefazolin",
            "cedax", "cefoxitin", "ceftazidime", "cefaclor", "cefadroxil", "cefdinir", "cefditoren",
            "cefepime", "cefotan", "cefotetan", "cefotaxime", "ceftaroline", "cefpodoxime", "cefpirome",
            "cefprozil", "ceftibuten", "ceftin", "ceftriaxone", "cefuroxime", "cephalexin", "cephalothin",
            "cephapririn", "chloramphenicol", "cipro", "ciprofloxacin", "claforan", "clarithromycin",
            "cleocin", "clindamycin", "cubicin", "dicloxacillin", "dirithromycin", "doryx", "doxycy",
            "duricef", "dynacin", "ery-tab", "eryped", "eryc", "erythrocin", "erythromycin", "factive",
            "flagyl", "fortaz", "furadantin", "garamycin", "gentamicin", "kanamycin", "keflex", "kefzol",
            "ketek", "levaquin", "levofloxacin", "lincocin", "linezolid", "macrobid", "macrodantin",
            "maxipime", "mefoxin", "metronidazole", "meropenem", "methicillin", "minocin", "minocycline",
            "monodox", "monurol", "morgidox", "moxatag", "moxifloxacin", "mupirocin", "myrac", "nafcillin",
            "neomycin", "nicazel doxy 30", "nitrofurantoin", "norfloxacin", "noroxin", "ocudox", "ofloxacin",
            "omnicef", "oracea", "oraxyl", "oxacillin", "pc pen vk", "pce dispertab", "panixine", "pediazole",
            "penicillin", "periostat", "pfizerpen", "piperacillin", "tazobactam", "primsol", "proquin",
            "raniclor", "rifadin", "rifampin", "rocephin", "smz-tmp", "septra", "septra ds", "solodyn",
            "spectracef", "streptomycin", "sulfadiazine", "sulfamethoxazole", "trimethoprim", "sulfatrim",
            "sulfisoxazole", "suprax", "synercid", "tazicef", "tetracycline", "timentin", "tobramycin",
            "unasyn", "vancocin", "vancomycin", "vantin", "vibativ", "vibra-tabs", "vibramycin", "zinacef",
            "zithromax", "zosyn", "zyvox",
        ],
    ),
]

# --- Fixed values: diagnosis codes ------------------------------------------------------------------
# A trailing % is part of the code as the source study compares it (equality), not a wildcard.

ESRD = ["5856", "40391", "N186", "V4511", "Z992", "I132", "I120"]
DIAGNOSES = {
    "diabetes": [
        "25000", "E119", "E1122", "3572", "E1165", "25060", "25040", "25002", "E1140", "25080", "E1151",
        "25050",
    ],
    "esrd": ESRD,
    "ckd": ESRD + ["40390", "5859", "E1122", "I129", "I130", "5853", "N183", "5854", "N184"],
    "steroids": ["T380X5A", "V5865"],
    "osa": ["32723", "G4733"],
    "depression": ["311"],
    "malnutrition": ["E440", "261", "V850", "R64", "7994", "Z681", "E43", "2639"],
    "obesity": [
        "E669", "27801", "E660%", "E662", "E661", "E668", "Z684%", "V8535", "V8536", "V8537", "V8538",
        "V8539", "Z6835", "Z6836", "Z6837", "Z6838", "Z6839", "V854%",
    ],
    "cad": ["41401", "I2510", "412", "41400", "I252", "Z955", "I255", "4148"],
    "chf": [
        "4280", "42833", "I110", "I5033", "I130", "42832", "4254", "I5023", "I255", "42843", "I5032", "I509",
        "I429", "I5022", "I420",
    ],
    "copd": ["496", "J449", "49121", "J441", "J440", "J439"],
    "aml": ["20500"],
    "dnr": ["V4986", "Z66"],
}

# --- Fixed values: variables and transforms of the first study --------------------------------------

BASELINE_VARIABLES = [
    "resp_rate", "heart_rate", "sbp", "dbp", "mbp", "GCS_motor", "GCS_verbal", "GCS_eyes", "uo_6h_rate",
    "pressor", "wob", "hb", "wbc", "plt", "cr", "lactate", "po2", "pco2", "ph", "bicarb", "trop", "alt",
    "glucose", "albumin", "temperature", "cxr", "aline", "cvc", "Foley", "lasix", "abx", "puffer",
    "opioid", "benzo", "antipsych",
]
COMA_PARTS = ["GCS_eyes", "GCS_motor", "GCS_verbal"]
BOUNDED = {"GCS": (2.9, 12.2), "spo2": (0.0, 101.0), "fio2": (20.9, 79.3)}
FIRST_TRANSFORMS = Transforms(
    logged=[
        "albumin", "alt", "bicarb", "bili", "cr", "dbp", "glucose", "hb", "heart_rate", "lactate", "mbp",
        "po2", "pco2", "ph", "plt", "resp_rate", "sbp", "temperature", "trop", "uo_6h_rate", "wbc",
    ],
    bounded=BOUNDED,
)
FIRST_STANDARDISED = [*FIRST_TRANSFORMS.logged, "spo2", "fio2", "GCS"]
FIRST_CONTINUOUS = ["sbp", "resp_rate", "heart_rate", "spo2", "fio2", "GCS", "po2", "ph", "pco2"]
FIRST_BINARY = ["wob", "pressor", "hfnc", "niv", "stdo2"]
FIRST_PREDICTED = ["sbp", "resp_rate", "heart_rate", "spo2", "GCS", "wob"]
FIRST_CARRIED = ["fio2", "pressor", "hfnc", "niv", "stdo2"]
FIRST_DEVICES = {"niv": [5], "hfnc": [4], "stdo2": [3, 2]}
SAMPLE_SIZE, SAMPLE_SEED = 400, 20210205

# --- Fixed values: report groups -------------------------------------------------------------------

AGE_BREAKS = [18, 40, 50, 60, 70, 80, 100]
AGE_LABELS = ["18-39", "40-49", "50-59", "60-69", "70-79", "80 or more"]
CARE_UNITS = {
    "Cardiac": ["Coronary Care Unit (CCU)", "Cardiac Vascular Intensive Care Unit (CVICU)"],
    "Neuro-trauma": [
        "Neuro Intermediate", "Neuro Stepdown", "Neuro Surgical Intensive Care Unit (Neuro SICU)",
        "Trauma SICU (TSICU)",
    ],
}
ETHNICITIES = {
    "White": ["WHITE"],
    "Black": ["BLACK/AFRICAN AMERICAN"],
    "Asian": ["ASIAN"],
    "Hispanic": ["HISPANIC/LATINO"],
    "Other": ["AMERICAN INDIAN/ALASKA NATIVE", "OTHER"],
}
FIRST_REPORT = [
    "agegroup", "sex", "ethnicity", "anchor_year_group", "careunit", "copd", "chf", "imv_ever", "icu_dc",
    "death_obs", "death28",
]
FIRST_REPORT_CONTINUOUS = ["spo2_bl", "fio2_bl", "resp_rate_bl"]
SECOND_REPORT = [
    "agegroup", "sex", "admissionyeargroup", "location", "goc", "imv", "icu_dc", "death_obs", "death28",
]

# --- Fixed values: items of the second database ----------------------------------------------------

OXYGEN_FLOW = [8845, 10387, 18587]
OXYGEN_SETTINGS = [6699, 12279, 12369, 16246]
NONINVASIVE_SETTINGS = [12369, 16246]
OXYGEN_ROUTE = 8189
ROUTES_FLOORED = [2, 7, 1, 3, 8, 9, 4, 18, 19, 10, 11, 13, 14, 15, 16, 17]
ROUTES_SCALED = [1, 3, 8, 9, 4, 18, 19, 10, 11, 13, 14, 15, 16, 17]
ROUTES_ROOM_AIR = [12]
ROUTES_TRACHEOSTOMY = [4, 18, 19, 11, 13, 14, 15]
ROUTE_NIV, ROUTE_NRB, ROUTE_IMV = 16, 17, 20
INTUBATION_ORDER = 9476
INTUBATION_PROCESS, NONINVASIVE_PROCESS = 9328, 10740
KPA_UNIT, MMHG_PER_KPA = 152, 7.50061683
PO2_ITEMS, PCO2_ITEMS, PH_ITEMS = [7433, 9996, 21214], [6846, 9990, 21213], [6848, 12310]
SPECIMEN_ITEM = 11646
CODE_STATUS_ITEM = "Beleid"
VITAL_ITEMS = {
    6640: "heart_rate", 6642: "mbp", 6679: "mbp", 8843: "mbp", 6709: "spo2",
}
DIAGNOSIS_ITEMS = [18669, 18671]
OPERATIVE = {18671: "%post-operati%", 18669: "operati%"}
RESPIRATORY = {18669: "%respirat%", 18671: "%respirat%"}
SEPSIS = {18669: "%sepsis%", 18671: "%sepsis%"}
PRESSOR_ITEMS = [7229, 7179, 6818, 9126]
PRESSOR_NAMES = ["Noradrenaline", "Adrenaline", "Dopamine"]

SECOND_LIMITS = {
    "mbp": (10, 200), "ph": (6.5, 8), "pco2": (1, None), "resp_rate": (1, 70), "heart_rate": (1, None),
    "spo2": (1, 100),
}
SECOND_STANDARDISED = [
    "heart_rate", "mbp", "po2", "pco2", "ph", "resp_rate", "spo2", "fio2", "GCS",
]
SECOND_TRANSFORMS = Transforms(
    logged=["heart_rate", "mbp", "po2", "pco2", "ph", "resp_rate"], bounded=BOUNDED
)
SECOND_CONTINUOUS = ["resp_rate", "heart_rate", "spo2", "fio2", "GCS", "po2", "ph", "pco2"]
SECOND_BINARY = ["pressor", "niv", "stdo2"]
SECOND_PREDICTED = ["resp_rate", "heart_rate", "spo2", "GCS"]
SECOND_CARRIED = ["fio2", "pressor", "niv", "stdo2"]
SECOND_SPARSE = ["ph", "pco2", "po2", "fio2", "niv", "stdo2"]
SECOND_DEVICES = {"niv": [ROUTE_NIV], "stdo2": [ROUTE_NRB]}

# --- Fixed values: study windows, in minutes -------------------------------------------------------

HOUR, DAY = 60, 1440
BEFORE_ADMISSION = 48 * HOUR
FOLLOW_UP = 120 * HOUR
SCREENING_LIMIT = 24 * HOUR
STAY_LIMIT = 144 * HOUR
