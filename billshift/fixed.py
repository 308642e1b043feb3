"""Values that callers' tables, saved models and published flags rely on."""

# Claim columns.
PROVIDER = "clm_blg_prvdr_npi_num"
CLAIM_TYPE = "clm_src_type"
SERVICE_DATE = "clm_line_from_dt"
EDUCATION_DATE = "current_education_date"
AMOUNT = "clm_sbmt_chrg_amt"
STATE = "state_cd"
HCPCS = "clm_line_hcpcs_cd"
MODIFIERS = ["hcpcs_1_mdfr_cd", "hcpcs_2_mdfr_cd"]
PRINCIPAL_DIAGNOSIS = "clm_prncpl_dgns_cd"
DIAGNOSES = [f"clm_dgns_{i}_cd" for i in range(1, 6)]
PROCEDURE = "clm_prcdr_cd"
NUMBERED_PROCEDURES = [f"clm_prcdr_{i}_cd" for i in range(1, 6)]

# Report, alert and configuration columns.
REPORT = "asrpt_id"
SUBJECT = "subj_id"
ALERT = "alert_id"
ALERT_DATE = "alert_creat_dt"
MAX_ALERT_DATE = "max_alert_date"
MODEL = "model_id"
MODEL_STATUS = "model_actvty_stus"
CONFIG_MODEL = "MODEL_BUSNS_ID"
CONFIG_KEY = "CONFIG_FLD"
CONFIG_VALUE = "CONFIG_FLD_VAL"

# Claim types, periods, the token for blank codes.
CLAIM_TYPES = ["A", "B", "DME"]
PERIODS = ["before", "after"]
#: Where an audit counts claims of any other type.
OTHER_TYPE = "other"
BLANK_TOKEN = "EMPTY"

# Thresholds.
MIN_CLAIMS = 50
ALPHA = 0.05
RECENT_DAYS = 365

# Published flags.
FLAG_EFFECTIVE = "N"
FLAG_NOT_EFFECTIVE = "Y"
FLAG_UNTESTABLE = "Untestable"
FLAG_RECENT = "<90days"
FLAG_NONE = "N/A"
FLAG_NEW_MODEL = "New Model"
LIVE_MODEL_STATUSES = ["Active", "Inactive"]

# Training settings.
SPLIT_FRACTIONS = [0.7, 0.3]
SPLIT_SEED = 1234
MAX_ITER = 100
TOLERANCE = 1e-6
REG_PARAM = 0.1
ELASTIC_NET = 1.0
ALGORITHM = "Linear Regression"

# Column names (spelling included) that readers of older tables expect.
PUBLISHED_RESULT = {
    "provider_id": "Educated_NPI",
    "average_difference": "Averge_Difference",
    "t_value": "Test_Value",
    "p_value": "P_value",
    "flag": "Flag",
}
PUBLISHED_EVALUATION = {
    "model_name": "Model_name",
    "algorithm": "Algorithm",
    "train_ts": "Train_ts",
    "train_time": "Train_time",
    "train_size": "Train_size",
    "rmse": "Root_Mean_Sqaured_Error",
    "mse": "Mean_Squared_Error",
    "r2": "R_Squared",
    "mae": "Mean_Absolute_Error",
}

# Sub-folders of saved pipelines, suffixes of result tables.
FITTED_FOLDER = "trainedpipeline"
UNFITTED_FOLDER = "pipeline"
WEIGHTS_FOLDER = "weights"
MODEL_FOLDERS = {"A": "parta", "B": "partb", "DME": "partdme"}
RESULT_SUFFIXES = [
    "npisuspect",
    "claimsatrisk",
    "claimsatriskptd",
    "reportcard",
    "reportcardsna",
    "supplementalrc",
]


def code_columns(kind: str) -> list[str]:
    """Code columns that feed the model of one claim type, in stage order."""
    if kind not in CLAIM_TYPES:
        raise ValueError(f"unknown claim type {kind!r}, expected one of {CLAIM_TYPES}")
    shared = [STATE, HCPCS, *MODIFIERS, PRINCIPAL_DIAGNOSIS, *DIAGNOSES]
    return shared + (NUMBERED_PROCEDURES if kind == "A" else [PROCEDURE])
