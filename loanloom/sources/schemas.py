"""Fields of raw loan and lease tapes. The names the filings use."""
from __future__ import annotations

from pyspark.sql import types as T

FIELDS: dict[str, dict[str, list[str]]] = {
    "loan": {
        "date": ["originalFirstPaymentDate", "originationDate", "reportingPeriodBeginningDate", "reportingPeriodEndingDate", "zeroBalanceEffectiveDate"],
        "boolean": ["assetAddedIndicator", "assetSubjectDemandIndicator", "coObligorIndicator", "reportingPeriodModificationIndicator", "repossessedIndicator", "underwritingIndicator"],
        "decimal": ["actualInterestCollectedAmount", "actualOtherCollectedAmount", "actualPrincipalCollectedAmount", "chargedoffPrincipalAmount", "originalLoanAmount", "otherAssessedUncollectedServicerFeeAmount", "otherPrincipalAdjustmentAmount", "recoveredAmount", "reportingPeriodActualEndBalanceAmount", "reportingPeriodBeginningLoanBalanceAmount", "reportingPeriodScheduledPaymentAmount", "totalActualAmountPaid", "nextReportingPeriodPaymentAmountDue", "repossessedProceedsAmount", "scheduledInterestAmount", "scheduledPrincipalAmount", "vehicleValueAmount", "servicerAdvancedAmount", "servicingFlatFeeAmount", "otherServicerFeeRetainedByServicer"],
        "integer": ["currentDelinquencyStatus", "gracePeriodNumber", "interestCalculationTypeCode", "obligorCreditScore", "obligorEmploymentVerificationCode", "obligorIncomeVerificationLevelCode", "originalInterestRateTypeCode", "originalLoanTerm", "paymentExtendedNumber", "paymentTypeCode", "remainingTermToMaturityNumber", "servicingAdvanceMethodCode", "vehicleModelYear", "vehicleNewUsedCode", "vehicleTypeCode", "vehicleValueSourceCode", "zeroBalanceCode", "originalInterestOnlyTermNumber"],
        "list": ["modificationTypeCode", "subvented"],
        "rate": ["nextInterestRatePercentage", "originalInterestRatePercentage", "paymentToIncomePercentage", "reportingPeriodInterestRatePercentage", "servicingFeePercentage"],
        "string": ["assetNumber", "assetTypeNumber", "obligorCreditScoreType", "obligorGeographicLocation", "originatorName", "primaryLoanServicerName", "securitizationKey", "vehicleManufacturerName", "vehicleModelName"],
        "zero": ["chargedoffPrincipalAmount", "repossessedProceedsAmount", "recoveredAmount", "otherPrincipalAdjustmentAmount"],
        "fill": ["obligorIncomeVerificationLevelCode", "obligorEmploymentVerificationCode", "obligorCreditScore", "currentDelinquencyStatus"],
    },
    "lease": {
        "date": ["originalFirstPaymentDate", "originationDate", "paidThroughDate", "reportingPeriodBeginDate", "reportingPeriodEndDate", "scheduledTerminationDate", "zeroBalanceEffectiveDate"],
        "boolean": ["assetAddedIndicator", "assetSubjectDemandIndicator", "coLesseePresentIndicator", "reportingPeriodModificationIndicator", "underwritingIndicator"],
        "decimal": ["acquisitionCost", "actualOtherCollectedAmount", "baseResidualValue", "chargedOffAmount", "contractResidualValue", "excessFeeAmount", "liquidationProceedsAmount", "nextReportingPeriodPaymentAmountDue", "otherAssessedUncollectedServicerFeeAmount", "otherLeaseLevelServicingFeesRetainedAmount", "reportingPeriodEndActualSecuritizationAmount", "reportingPeriodEndingActualBalanceAmount", "reportingPeriodScheduledPaymentAmount", "reportingPeriodSecuritizationValueAmount", "repurchaseAmount", "servicerAdvancedAmount", "servicingFlatFeeAmount", "totalActualAmountPaid", "vehicleValueAmount"],
        "integer": ["baseResidualSourceCode", "currentDelinquencyStatus", "gracePeriod", "leaseExtended", "lesseeCreditScore", "lesseeEmploymentVerificationCode", "lesseeIncomeVerificationLevelCode", "modificationTypeCode", "originalLeaseTermNumber", "paymentTypeCode", "remainingTermNumber", "servicingAdvanceMethodCode", "terminationIndicator", "vehicleModelYear", "vehicleNewUsedCode", "vehicleTypeCode", "vehicleValueSourceCode", "zeroBalanceCode"],
        "list": ["subvented"],
        "rate": ["paymentToIncomePercentage", "securitizationDiscountRate", "servicingFeePercentage"],
        "string": ["assetNumber", "assetTypeNumber", "lesseeCreditScoreType", "lesseeGeographicLocation", "originatorName", "primaryLeaseServicerName", "securitizationKey", "shelf", "vehicleManufacturerName", "vehicleModelName"],
        "zero": ["chargedOffAmount", "liquidationProceedsAmount", "repurchaseAmount", "actualOtherCollectedAmount", "excessFeeAmount", "totalActualAmountPaid"],
        "fill": ["lesseeIncomeVerificationLevelCode", "lesseeEmploymentVerificationCode", "lesseeCreditScore", "currentDelinquencyStatus", "zeroBalanceCode", "terminationIndicator"],
    },
}


def raw_schema(kind: str = "loan", keep: list[str] | None = None) -> T.StructType:
    """All fields as text, repeated ones as arrays; absent elements are null. ``keep`` prunes."""
    f = FIELDS[kind]
    names = [c for k in ("date", "boolean", "decimal", "integer", "rate", "string") for c in f[k] if c not in ("securitizationKey", "shelf")]
    fields = [T.StructField(c, T.StringType()) for c in dict.fromkeys(names)] + [T.StructField(c, T.ArrayType(T.StringType())) for c in f["list"] if c not in names]
    return T.StructType([x for x in fields if keep is None or x.name in keep])
