"""Fixed values of the clinical features: cut points, caps and category labels."""

# --- fixed values: numeric cut points -------------------------------------------------
GLUCOSE_NORMAL_MAX = 99
GLUCOSE_PREDIABETES_MAX = 125
HBA1C_NORMAL_MAX = 5.7
HBA1C_PREDIABETES_MAX = 6.4
BMI_UNDERWEIGHT_MAX = 18.5
BMI_NORMAL_MAX = 25
BMI_OVERWEIGHT_MAX = 30
SBP_NORMAL_MAX = 119
SBP_PREHYPERTENSION_MAX = 139
DBP_NORMAL_MAX = 79
DBP_PREHYPERTENSION_MAX = 89
HOMA_IR_DIVISOR = 405
HOMA_IR_RESISTANCE = 2.5
SYNDROME_BMI = 30
SYNDROME_SBP = 130
SYNDROME_TRIGLYCERIDES = 150
SYNDROME_HDL = 40
SYNDROME_GLUCOSE = 110
SYNDROME_MIN_CRITERIA = 3
ACTIVITY_TARGET_MINUTES = 150
ACTIVITY_RATIO_CAP = 3
SCREEN_SLEEP_CAP = 5
IDEAL_SLEEP_HOURS = 8
SEDENTARY_SCREEN_HOURS = 6
SLEEP_EFFICIENCY_CAP = 2
LIFESTYLE_POINTS = 2
LIFESTYLE_DIET_MIN = 6
LIFESTYLE_SLEEP_RANGE = (7, 9)
LIFESTYLE_ALCOHOL_MAX = 2

# --- fixed values: labels (the dash in the age groups is U+2013) ------------------------
INFINITY = float("inf")
AGE_DETAILED_EDGES = [0, 30, 40, 50, 60, 70, 80, INFINITY]
AGE_DETAILED_LABELS = ["<30", "30–39", "40–49", "50–59", "60–69", "70–79", "80+"]
AGE_COARSE_EDGES = [0, 30, 60, INFINITY]
AGE_COARSE_LABELS = ["Young", "Adult", "Senior"]
GLYCEMIC_LABELS = ["Normal", "Pre-Diabetes", "Diabetes"]
BMI_LABELS = ["Underweight", "Normal", "Overweight", "Obese"]
BP_LABELS = ["Normal", "Pre-Hypertension"]
BP_DEFAULT = "Hypertension"
LOW_INCOME = ["Low", "Lower-Middle"]
LOW_EDUCATION = ["No formal", "Highschool"]
NEVER_SMOKER = "Never"
