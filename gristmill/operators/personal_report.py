"""Personal-data report of a dialogue corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gristmill.functions import personal as p
from gristmill.operators.profile import count_hits


def personal_data_report(
    df: DataFrame, patient: str = "patient", doctor: str = "doctor"
) -> DataFrame:
    """Hits per pattern and side in one scan and one aggregate.

    Patient-side e-mails, URLs and phones are counted here but no operator
    removes them; doctor-side phones are neither counted nor removed.
    """
    return count_hits(df, {
        "patient_email": p.has_email(patient),
        "patient_url": p.has_url(patient),
        "patient_phone": p.has_phone(patient),
        "patient_name": p.has_stated_name(patient),
        "doctor_signature": p.has_signature(doctor),
        "doctor_url": p.has_url(doctor),
        "doctor_email": p.has_email(doctor),
    })
