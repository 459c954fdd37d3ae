"""Fixed schemas: codes are always text, money and counts of people are always double."""

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


S, D, L = T.StringType(), T.DoubleType(), T.LongType()

RVU = _schema(
    ("HCPCS", S), ("DESCRIPTION", S), ("STATUS_CODE", S), ("WORK_RVU", D), ("NON_FAC_PE_RVU", D),
    ("FACILITY_PE_RVU", D), ("MP_RVU", D), ("CONVERSION_FACTOR_FROM_FILE", D),
)
GPCI = _schema(
    ("MAC", S), ("State", S), ("Locality_Number", S), ("Locality_Name", S),
    ("WORK_GPCI", D), ("PE_GPCI", D), ("MP_GPCI", D),
)
PAYMENTS = _schema(
    ("Rndrng_NPI", L), ("Rndrng_Prvdr_State_Abrvtn", S), ("Rndrng_Prvdr_Type", S),
    ("HCPCS_Cd", S), ("Place_Of_Srvc", S), ("Tot_Benes", D), ("Tot_Srvcs", D),
    ("Avg_Sbmtd_Chrg", D), ("Avg_Mdcr_Alowd_Amt", D), ("Avg_Mdcr_Pymt_Amt", D),
    ("Rndrng_Prvdr_Mdcr_Prtcptg_Ind", S), ("Rndrng_Prvdr_Ent_Cd", S),
)
CLAIM_COLUMNS = [
    "Rndrng_NPI", "Rndrng_Prvdr_Type", "Rndrng_Prvdr_State_Abrvtn", "HCPCS_Cd", "Place_Of_Srvc",
    "Tot_Benes", "Tot_Srvcs", "Avg_Sbmtd_Chrg", "Avg_Mdcr_Alowd_Amt", "Avg_Mdcr_Pymt_Amt",
    "Rndrng_Prvdr_Mdcr_Prtcptg_Ind", "Rndrng_Prvdr_Ent_Cd",
    "Expected_Payment_NonFacility_Avg", "Expected_Payment_Facility_Avg", "Expected_Payment_Used",
    "Locality_Count", "Payment_Gap", "Payment_Gap_Pct", "Is_Underpaid", "Total_Dollar_Gap",
]
QUEUE_COLUMNS = [
    "rank", "Rndrng_NPI", "Rndrng_Prvdr_Type", "Rndrng_Prvdr_State_Abrvtn", "HCPCS_Cd",
    "Place_Of_Srvc", "payer_type_proxy", "Tot_Srvcs", "Avg_Mdcr_Alowd_Amt",
    "Expected_Payment_Used", "Payment_Gap", "Payment_Gap_Pct", "estimated_recovery",
    "is_surgical_hcpcs", "requires_modifier_review", "modifier_review_reason",
    "rule_confidence_score", "collection_probability", "collection_model_name",
    "model_operating_threshold", "predicted_high_priority", "confidence_score",
    "priority_score", "priority_tier", "recommended_action",
]
# Scorer request record: field -> (type, default); None means "derive from the others".
CLAIM_RECORD = {
    "procedure_category": (S, "Evaluation_and_Management"),
    "payer_type_proxy": (S, "Medicare_Participating"),
    "place_of_service": (S, "O"),
    "tot_srvcs": (D, 50.0),
    "tot_benes": (D, 30.0),
    "avg_sbmtd_chrg": (D, 250.0),
    "tot_srvcs_log": (D, None),
    "tot_benes_log": (D, None),
    "avg_sbmtd_chrg_log": (D, None),
    "services_per_beneficiary": (D, None),
    "review_flag": (D, 0.0),
    "duplicate_key_flag": (D, 0.0),
    "zero_expected_reason_flag": (D, 0.0),
    "locality_count": (D, 1.0),
    "ruca_unknown_flag": (D, 0.0),
    "provider_row_count": (D, 0.0),
    "provider_total_services": (D, 0.0),
    "hcpcs_row_count": (D, 0.0),
    "hcpcs_total_services": (D, 0.0),
    "state_row_count": (D, 0.0),
    "state_total_services": (D, 0.0),
    "hcpcs_state_row_share": (D, 0.0),
    "avg_charge_per_beneficiary": (D, None),
    "provider_service_share": (D, 0.0),
    "hcpcs_service_share_in_state": (D, 0.0),
}
