"""Table contracts: column roles, types, domains and ranges as plain data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """A table, file or request set breaks its contract."""


@dataclass(frozen=True)
class ColumnContract:
    """One typed column, where it comes from and which values it may hold."""

    name: str
    kind: str = "string"
    source: str | None = None
    required: bool = False
    domain: tuple[str, ...] = ()
    pattern: str | None = None
    minimum: int | None = None
    maximum: int | None = None
    remap: dict[str, str] = field(default_factory=dict)

    @property
    def raw_name(self) -> str:
        return self.source or self.name

    @property
    def check_name(self) -> str | None:
        """Name of the value check, None when any value is allowed."""
        if self.domain or self.pattern:
            return f"{self.name}_domain"
        if self.minimum is not None and self.maximum is not None:
            return f"{self.name}_between_{self.minimum}_and_{self.maximum}"
        if self.minimum == 0:
            return f"{self.name}_nonnegative"
        return None

    def violation(self) -> Column:
        """True where the value breaks the contract; never NULL."""
        value = F.col(self.name)
        if self.domain:
            bad = ~value.isin(*self.domain)
        elif self.pattern:
            bad = ~value.rlike(self.pattern)
        elif self.maximum is not None:
            bad = ~value.between(self.minimum, self.maximum)
        else:
            bad = value < self.minimum
        return (value.isNull() | bad) if self.required else (value.isNotNull() & bad)


@dataclass(frozen=True)
class TableContract:
    """A modeling table: identifier, label, roles and value contracts."""

    identifier: str
    label: str
    columns: tuple[ColumnContract, ...]
    numeric: tuple[str, ...]
    nominal: tuple[str, ...]
    ordinal: dict[str, tuple[str, ...]]
    high_cardinality: tuple[str, ...] = ()
    protected: tuple[str, ...] = ()
    lineage: tuple[str, ...] = ("source_uri", "source_sha256")
    excluded: dict[str, str] = field(default_factory=dict)

    @property
    def raw_columns(self) -> list[str]:
        return [column.raw_name for column in self.columns]

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.raw_columns])

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.high_cardinality, *self.nominal, *self.ordinal]

    @property
    def scan_columns(self) -> list[str]:
        """Identifier, features, protected columns, label and data hash, in order."""
        return [self.identifier, *self.features, *self.protected, self.label, self.lineage[-1]]


def require_columns(df: DataFrame, names: list[str]) -> None:
    """Fail, without a job, when ``df`` lacks a column."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ContractError("missing required columns: " + ", ".join(missing))


# Fixed values of the people contract, each list in its natural order.
GENDERS = ("Female", "Male", "Other")
RELEVANT_EXPERIENCE = ("Has relevant experience", "No relevant experience")
ENROLLED_UNIVERSITY = ("Full time course", "Part time course", "no_enrollment")
EDUCATION_LEVELS = ("Primary School", "High School", "Graduate", "Masters", "Phd")
MAJOR_DISCIPLINES = ("Arts", "Business Degree", "Humanities", "No Major", "Other", "STEM")
EXPERIENCE = ("<1", *(str(years) for years in range(1, 21)), ">20")
COMPANY_SIZES = (
    "<10", "10/49", "50-99", "100-500", "500-999", "1000-4999", "5000-9999", "10000+",
)
COMPANY_TYPES = (
    "Early Stage Startup", "Funded Startup", "NGO", "Other", "Public Sector", "Pvt Ltd",
)
LAST_NEW_JOB = ("never", "1", "2", "3", "4", ">4")
CITY_PATTERN = r"^city_[0-9]+\z"
RELEVANT_EXPERIENCE_SPELLING = {
    "Has relevent experience": "Has relevant experience",
    "No relevent experience": "No relevant experience",
}

PEOPLE = TableContract(
    identifier="enrollee_id",
    label="target",
    columns=(
        ColumnContract("enrollee_id", kind="bigint"),
        ColumnContract("city", required=True, pattern=CITY_PATTERN),
        ColumnContract("city_development_index", kind="double", required=True, minimum=0, maximum=1),
        ColumnContract("gender", domain=GENDERS),
        ColumnContract(
            "relevant_experience",
            source="relevent_experience",
            required=True,
            domain=RELEVANT_EXPERIENCE,
            remap=RELEVANT_EXPERIENCE_SPELLING,
        ),
        ColumnContract("enrolled_university", domain=ENROLLED_UNIVERSITY),
        ColumnContract("education_level", domain=EDUCATION_LEVELS),
        ColumnContract("major_discipline", domain=MAJOR_DISCIPLINES),
        ColumnContract("experience", domain=EXPERIENCE),
        ColumnContract("company_size", domain=COMPANY_SIZES),
        ColumnContract("company_type", domain=COMPANY_TYPES),
        ColumnContract("last_new_job", domain=LAST_NEW_JOB),
        ColumnContract("training_hours", kind="bigint", required=True, minimum=0),
        ColumnContract("target", kind="binary"),
    ),
    numeric=("city_development_index",),
    high_cardinality=("city",),
    nominal=(
        "relevant_experience", "enrolled_university", "major_discipline", "company_type", "last_new_job",
    ),
    ordinal={
        "education_level": EDUCATION_LEVELS,
        "experience": EXPERIENCE,
        "company_size": COMPANY_SIZES,
    },
    protected=("gender",),
    excluded={
        "enrollee_id": "names a person; used for splits, never as a feature",
        "gender": "protected; used by the fairness report only",
        "training_hours": "known only after the decision that is predicted",
        "target": "the label",
        "source_sha256": "says where the row comes from",
    },
)
