"""Built-in tables.  All are fixed values that results depend on; a configuration may replace any of them."""

from __future__ import annotations

#: Populations: marker requirements by name.
POPULATIONS = {
    "CD14 pos": {"CD14": "above"},
    "CD16 pos": {"CD16": "above"},
    "CD14 int CD16 int": {"CD14": "intermediate", "CD16": "intermediate"},
    "CD3 pos": {"CD3": "above"},
    "CD3 pos CD4 pos": {"CD3": "above", "CD4": "above"},
    "CD3 pos CD4 pos CD127 lo CD25 hi": {"CD3": "above", "CD4": "above", "CD127": "below", "CD25": "above"},
    "CD3 pos CD4 pos Vd1 pos": {"CD3": "above", "CD4": "above", "TCR-Vd1": "above"},
    "CD3 pos CD4 pos Vd2 pos": {"CD3": "above", "CD4": "above", "TCR-Vd2": "above"},
    "CD3 pos CD8 pos": {"CD3": "above", "CD8": "above"},
    "CD3 pos CD8 pos Vd1 pos": {"CD3": "above", "CD8": "above", "TCR-Vd1": "above"},
    "CD3 pos CD8 pos Vd2 pos": {"CD3": "above", "CD8": "above", "TCR-Vd2": "above"},
    "CD3 pos Vd1 pos": {"CD3": "above", "TCR-Vd1": "above"},
    "CD3 pos Vd2 pos": {"CD3": "above", "TCR-Vd2": "above"},
    "CD56 pos NKG2D pos": {"CD56": "above", "NKG2D": "above"},
    "CD19 pos": {"CD19": "above"},
}

MONOCYTES = ["CD14 pos", "CD16 pos", "CD14 int CD16 int"]

#: Functional marker blocks and the populations they are about.
FUNCTIONAL_BLOCKS = {
    "exhaustion": {"markers": ["LAG-3", "TIM-3", "PD-1", "CTLA-4"], "exclude": MONOCYTES},
    "homing": {"markers": ["CCR5", "CCR9", "CXCR3"], "require": "CD3"},
    "activation": {"markers": ["CD69", "HLA-DR", "CD25", "CD57", "CD38"], "require": "CD3"},
    "monocyte": {"markers": ["HLA-DR", "BTN2A2", "BTN3A1/2/3"], "populations": MONOCYTES},
    "cytokine": {"markers": ["IFNg", "TNF", "IL-17a", "Granzyme B", "Perforin", "CD107a"], "exclude": MONOCYTES},
}

#: Markers an embedding prefers.
LINEAGE = ["CD3", "CD4", "CD8", "CD14", "CD19", "CD56", "CD16", "HLA-DR", "TCR-Vd1", "TCR-Vd2", "CD25", "CD127", "CD57"]

#: Names by which viability dyes are known (regular expression, without case).
VIABILITY = r"zombie|live.?dead|^l/d$|^ld$|7.?aad|dapi|viability|propidium|^pi$|sytox|dracula"

#: Header spellings of patient tables by canonical name.
HEADERS = {
    "patient_id": ["patient_id", "ID", "Patient", "PatientID", "Patienten-ID", "Patient ID", "SubjectID", "Subject"],
    "date_of_birth": ["date_of_birth", "Geburtsdatum", "GebDatum", "Geburtstag", "DOB", "Birthdate", "Date of Birth"],
    "sex": ["sex", "Geschlecht", "Sex", "Gender"],
    "infection_focus": ["infection_focus", "Fokus", "Infektionsfokus", "Focus", "Infection focus"],
    "age_years": ["age_years", "Alter", "Age", "Age (years)", "age"],
    "height_cm": ["height_cm", "Groesse", "Grösse", "Größe", "Grosse", "Height", "Height (cm)"],
    "weight_kg": ["weight_kg", "Gewicht", "Weight", "Weight (kg)"],
    "cohort": ["cohort", "Cohort", "Kohorte", "Group", "Gruppe", "Genotype", "Diagnosis", "Diagnose", "Arm"],
    "wbc_per_ul": ["wbc_per_ul", "WBC", "WBC/uL", "WBC_per_uL", "wbc", "Leukozyten", "Leukozyten/uL", "Leukocytes", "leukocytes_per_ul", "absolute_wbc", "Leukos"],
}

#: Value translations by column.
VALUES = {
    "sex": {"m": "male", "w": "female", "f": "female", "weiblich": "female", "männlich": "male", "maennlich": "male", "male": "male", "female": "female", "man": "male", "woman": "female"},
    "infection_focus": {
        "Lunge": "lung", "pulmonal": "pulmonary", "Pneumonie": "pneumonia", "Abdomen": "abdomen", "abdominell": "abdominal", "Peritonitis": "peritonitis", "Cholangitis": "cholangitis",
        "Cholezystitis": "cholecystitis", "Harnwege": "urinary tract", "Harnwegsinfekt": "urinary tract infection", "Urosepsis": "urosepsis", "Niere": "kidney", "Haut": "skin", "Weichteile": "soft tissue",
        "Wunde": "wound", "Abszess": "abscess", "Erysipel": "erysipelas", "Fasziitis": "fasciitis", "Knochen": "bone", "Gelenk": "joint", "Knie": "knee", "Hüfte": "hip", "Osteomyelitis": "osteomyelitis",
        "Spondylodiszitis": "spondylodiscitis", "Spondylitis": "spondylitis", "infizierte Hüft-TEP": "infected hip prosthesis", "Hüft-TEP": "hip prosthesis", "Knie-TEP": "knee prosthesis",
        "Protheseninfekt": "prosthetic joint infection", "Endokarditis": "endocarditis", "Myokarditis": "myocarditis", "Meningitis": "meningitis", "Encephalitis": "encephalitis", "Katheter": "catheter",
        "ZVK": "central venous catheter", "Port": "port catheter", "ZNS": "central nervous system", "Weichgewebe": "soft tissue", "Mediastinitis": "mediastinitis", "Sinusitis": "sinusitis",
        "Tonsillitis": "tonsillitis", "Bakteriämie": "bacteraemia", "Sepsis": "sepsis", "unbekannt": "unknown", "unklar": "unclear", "keiner": "none", "kein": "none", "Sonstige": "other", "andere": "other",
    },
}
