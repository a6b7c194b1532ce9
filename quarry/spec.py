"""Table specifications: schema, keys, defaults and checks.

A parquet table cannot enforce PRIMARY KEY, CHECK or NOT NULL (Spark accepts
NOT NULL in DDL but does not enforce it), so every rule here is turned into a
validation job by ``quarry.operators.quality`` before a write.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    generated_key: bool = False
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    minimums: dict[str, float] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()

    def ddl(self, location: str | None = None) -> str:
        cols = []
        for f in self.schema.fields:
            piece = f"`{f.name}` {f.dataType.simpleString()}"
            if f.name in self.defaults:
                piece += f" DEFAULT '{self.defaults[f.name]}'" if isinstance(self.defaults[f.name], str) \
                    else f" DEFAULT {self.defaults[f.name]}"
            cols.append(piece)
        loc = f" LOCATION '{location}'" if location else ""
        return f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join(cols)}) USING parquet{loc}"


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# ---- clinic tables: column names, checks and defaults are fixed values ----

PATIENTS = TableSpec(
    "patients", _schema(("patient_id", L), ("name", S), ("email", S), ("phone", S), ("dob", S)),
    primary_key=("patient_id",), generated_key=True,
    not_null=("name", "email", "phone", "dob"), unique=("email",),
)
DOCTORS = TableSpec(
    "doctors", _schema(("doctor_id", L), ("name", S), ("specialty", S), ("experience_years", I),
                       ("consultation_fee", D)),
    primary_key=("doctor_id",), generated_key=True,
    not_null=("name", "specialty", "experience_years", "consultation_fee"),
)
APPOINTMENTS = TableSpec(
    "appointments", _schema(("appointment_id", L), ("patient_id", L), ("doctor_id", L),
                            ("appointment_date", S), ("time_slot", S), ("status", S)),
    primary_key=("appointment_id",), generated_key=True,
    not_null=("patient_id", "doctor_id", "appointment_date", "time_slot"),
    defaults={"status": "Pending"},
    foreign_keys=(ForeignKey(("patient_id",), "patients", ("patient_id",)),
                  ForeignKey(("doctor_id",), "doctors", ("doctor_id",))),
)
BILLING = TableSpec(
    "billing", _schema(("billing_id", L), ("appointment_id", L), ("amount_due", D), ("payment_status", S)),
    primary_key=("billing_id",), generated_key=True,
    not_null=("appointment_id", "amount_due"), minimums={"amount_due": 0.0},
    defaults={"payment_status": "Unpaid"},
    foreign_keys=(ForeignKey(("appointment_id",), "appointments", ("appointment_id",)),),
)
CLINIC_TABLES = (PATIENTS, DOCTORS, APPOINTMENTS, BILLING)

# Specialty, years of experience and fee of the sample doctors.
DOCTOR_SAMPLE_ROWS = [
    ("Cardiology", 15, 150.0),
    ("Pediatrics", 10, 100.0),
    ("Orthopedics", 12, 120.0),
    ("Dermatology", 8, 90.0),
    ("Neurology", 14, 180.0),
]
