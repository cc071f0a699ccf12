"""Rules and policies, with the reference's values as defaults."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the reference's for equal results.
# ---------------------------------------------------------------------------

# Point contract enums.
QUALITIES = ("Good", "Bad", "Uncertain")
SILVER_QUALITIES = ("Good", "Uncertain")
SOURCE_SYSTEMS = ("mock_pi", "aveva_pi")

# Health score: 100 - 15*max(vib-2.5,0) - 2*max(temp-70,0) - 1.5*max(amps-48,0),
# clamped to [0, 100]; anomaly when vib > 4.0 or temp > 85.
# Signals are the tag suffixes Vibration, BearingTemp, MotorAmps, RunStatus.

# Names replaced by [PERSON] in the serving shift notes (reference policy).
REFERENCE_REDACT_NAMES = (
    "Jordan Lee", "Sam Rivera", "Alex Chen", "Morgan Patel",
    "Riley Quinn", "Casey Brooks", "Taylor Kim", "Jamie Ortiz",
)
PERSON_TOKEN = "[PERSON]"

# Column masks.
EMAIL_MASK_PATTERN = "(^.).*(@.*$)"
EMAIL_MASK_REPLACEMENT = "$1***$2"
PHONE_MASK_PREFIX = "***-***-"
NAME_MASK = "REDACTED"
PLANT_GROUP_PREFIX = "plant_"

# Technician role by work-order priority: <=1 reliability_oncall, =2 technician,
# anything else (NULL included) planner.
ROLE_ONCALL, ROLE_TECHNICIAN, ROLE_PLANNER = "reliability_oncall", "technician", "planner"

# Tag catalogue: suffix, uom, description, nominal, noise_pct, drift_per_hour.
TAG_SPECS = (
    ("Vibration", "mm/s", "RMS vibration", 2.5, 0.08, 0.015),
    ("BearingTemp", "degC", "Drive-end bearing temperature", 65.0, 0.03, 0.02),
    ("SuctionPressure", "bar", "Suction pressure", 1.2, 0.04, 0.0),
    ("DischargePressure", "bar", "Discharge pressure", 8.5, 0.05, 0.0),
    ("MotorAmps", "A", "Motor current", 42.0, 0.06, 0.01),
    ("RunStatus", "bool", "Running=1 / Stopped=0", 1.0, 0.0, 0.0),
    ("RuntimeHours", "h", "Cumulative runtime hours", 12400.0, 0.0, 1.0),
)

# Governance inventory (fixed values): table, column, kind of personal data, sensitivity, domain, days kept.
# Masks, row filters and retention below are all derived from it.
CLASSIFIED = (
    ("work_order_people", "technician_name", "direct", "high", "cmms", 730),
    ("work_order_people", "technician_email", "direct", "high", "cmms", 730),
    ("work_order_people", "technician_badge_id", "direct", "high", "cmms", 730),
    ("work_order_people", "technician_employee_id", "quasi", "medium", "cmms", 730),
    ("alarm_ack_people", "acked_by_name", "direct", "medium", "alarms", 365),
    ("alarm_ack_people", "acked_by_employee_id", "quasi", "medium", "alarms", 365),
    ("shift_people", "supervisor_name", "direct", "high", "workforce", 90),
    ("shift_people", "supervisor_email", "direct", "high", "workforce", 90),
    ("shift_people", "supervisor_phone", "direct", "high", "workforce", 90),
    ("shift_people", "supervisor_employee_id", "direct", "high", "workforce", 90),
    ("shift_people", "operator_name", "direct", "high", "workforce", 90),
    ("shift_people", "operator_email", "direct", "high", "workforce", 90),
    ("shift_people", "operator_phone", "direct", "high", "workforce", 90),
    ("shift_people", "operator_employee_id", "direct", "high", "workforce", 90),
    ("shift_people", "handoff_notes", "sensitive_text", "high", "workforce", 90),
    ("shift_people", "crew_id", "quasi", "medium", "workforce", 90),
)
RETENTION_DAYS = {table: days for table, *_, days in CLASSIFIED}

# Default windows of the consumer tools.
DEFAULT_WINDOW_HOURS = 24
DEFAULT_RECENT_DAYS = 7


@dataclass(frozen=True)
class HealthRule:
    """Constants of the daily health score (GLD-03)."""

    vib_nominal: float = 2.5
    vib_weight: float = 15.0
    temp_nominal: float = 70.0
    temp_weight: float = 2.0
    amps_nominal: float = 48.0
    amps_weight: float = 1.5
    vib_alarm: float = 4.0
    temp_alarm: float = 85.0
    floor: float = 0.0
    ceiling: float = 100.0
    vib_suffix: str = "Vibration"
    temp_suffix: str = "BearingTemp"
    amps_suffix: str = "MotorAmps"
    run_suffix: str = "RunStatus"


@dataclass(frozen=True)
class MaskBinding:
    table: str
    column: str
    mask: str  # "email" | "phone" | "name" | "notes"


@dataclass(frozen=True)
class Policy:
    """Which columns are masked and which tables are row-filtered.

    ``reference`` reproduces the eight bindings and two row filters of the
    reference; ``strict`` closes the gaps listed as trap T13/T14.
    """

    name: str
    masks: tuple[MaskBinding, ...]
    row_filtered: tuple[str, ...]
    strict_formats: bool = False
    privileged_group: str = "pii_readers"

    def masks_for(self, table: str) -> dict[str, str]:
        return {m.column: m.mask for m in self.masks if m.table == table}


def _mask_kind(column: str, pii: str) -> str:
    """Mask of a classified column, from its kind and name."""
    if pii == "sensitive_text":
        return "notes"
    kind = column.rpartition("_")[2]
    return kind if kind in ("email", "phone") else "name"


def _bindings(tables: tuple[str, ...], kept: tuple[str, ...]) -> tuple[MaskBinding, ...]:
    """Bindings of the classified columns of ``tables`` whose name ends with one of ``kept``."""
    return tuple(MaskBinding(t, c, _mask_kind(c, pii)) for t, c, pii, *_ in CLASSIFIED
                 if t in tables and pii in ("direct", "sensitive_text") and c.endswith(kept))


#: The reference masks contact data and names of these two tables; badge ids, alarm names and notes stay clear.
_REFERENCE_TABLES = ("work_order_people", "shift_people")
REFERENCE_POLICY = Policy(
    name="reference",
    masks=_bindings(_REFERENCE_TABLES, ("_email", "_phone", "_name")),
    row_filtered=tuple(t for t in RETENTION_DAYS if t in _REFERENCE_TABLES),
)

STRICT_POLICY = Policy(
    name="strict",
    masks=_bindings(tuple(RETENTION_DAYS), ("_email", "_phone", "_name", "_badge_id", "_notes")),
    row_filtered=tuple(RETENTION_DAYS),
    strict_formats=True,
)


@dataclass(frozen=True)
class RcaRule:
    """Evidence rules for the incident (RCA) tool, TOOL-15."""

    min_points: int = 2           # a slope needs two points
    min_delta: float = 0.0        # last - first must exceed this
    bucket: str = "HOUR"           # bucket of the windows x points join (points have one bucket each)
    interval_bucket: str = "HOUR"  # leaf bucket of the windows x alarms / downtime stabbing join


@dataclass(frozen=True)
class LeakPatterns:
    """Patterns of the content leak audit (GOV-08).

    Plain character classes only, so that Java regex and RE2 agree.
    """

    email: str = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z][A-Za-z]+"
    phone: str = r"[+]?[0-9]{1,3}[-. ][0-9]{3}[-. ][0-9]{4}"
    # A whole number with its country code, for masking: no digit group stays behind.
    phone_number: str = r"[+]?(?:[0-9]{1,3}[-. ])?(?:[(]?[0-9]{3}[)]?[-. ])?[0-9]{3}[-. ][0-9]{4}"
