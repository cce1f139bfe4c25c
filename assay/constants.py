"""Fixed values that must equal the reference's for compatible results.

These are the names and rules a user of the reference relies on: column names of
the silver / gold tables, the verdict that marks an anomaly, the statistics
computed per sensor, the thresholds of the sweep and the labels of the outcome
table. They are plain data; every operator takes them as overridable defaults.
"""

# --- fixed values: reference column names and rules -------------------------
SERIAL = "SERIAL_NUMBER"
PRODUCT = "PRODUCT_NUMBER"
STAND = "TEST_STAND"
RESULT = "RESULT"
LABEL = "LABEL"
TS = "TS"
PHASE = "PHASE"
DATE = "DATE"
TIME = "HEURE"

# Sensor columns kept in silver (SENSOR_3 is dropped: constant 0).
SENSORS = ["PR_1", "PR_2", "PR_3", "PR_4", "TEMP_1", "TEMP_2", "BRAKE_1",
           "SPEED_1", "SENSOR_1", "SENSOR_2", "SENSOR_4", "SENSOR_5"]
DROPPED_SENSORS = ["SENSOR_3"]

# Verdict string that means "anomalous"; anything else (incl. NULL) is good.
ANOMALY_VERDICT = "W"
GOOD_VERDICT = "G"

# Date-time format of DATE + ' ' + HEURE in the source files.
SOURCE_TS_FORMAT = "dd/MM/yyyy HH:mm:ss"

# The 32-hex serial carried by a time-series file name.
SERIAL_PATTERN = r"([0-9a-fA-F]{32})"

# Per-sensor statistics, in this order, with these suffixes.
STATS = ["mean", "std", "min", "max", "med"]

# Test-run metadata columns: computed for audit, never used as features.
LEAK_COUNT = "_leak_nb_mesures"
LEAK_PHASES = "_leak_nb_programmes"
LEAK_DURATION = "_leak_duree_sec"
LEAK_COLUMNS = [LEAK_COUNT, LEAK_PHASES, LEAK_DURATION]

# Optional product attributes of the dimension, in this order.
PRODUCT_ATTRIBUTES = ["GROUP", "NATURE", "MODEL", "STATUS"]

# Threshold sweep and final decision threshold.
SWEEP_THRESHOLDS = [0.50, 0.45, 0.40, 0.35, 0.30, 0.25, 0.20, 0.15, 0.10, 0.05]
FINAL_THRESHOLD = 0.05

# Scored-table columns and outcome labels.
PROBABILITY = "PROBABILITE_ANOMALIE"
FINAL_PREDICTION = "PREDICTION_FINALE"
OUTCOME = "RESULTAT"
OUTCOME_TP = "Vrai positif"
OUTCOME_FP = "Faux positif"
OUTCOME_FN = "Faux négatif"
OUTCOME_TN = "Vrai négatif"

# Split: 80 / 20 with seed 42.
TRAIN_FRACTION = 0.8
SPLIT_SEED = 42

# Model hyper-parameters.
LR_MAX_ITER = 100
RF_NUM_TREES = 200
RF_MAX_DEPTH = 8
GBT_MAX_ITER = 50
GBT_MAX_DEPTH = 5
SVM_MAX_ITER = 100
MODEL_SEED = 42
# --- end of fixed values ----------------------------------------------------
