"""Domain knowledge as rows. They have to be as they are for right results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FAMILY = "83513"
CAVITIES = [9, 15, 21, 25, 31, 37, 51, 100]
FINISHES = [
    ("A", "Pure electrodeposited aluminum"),
    ("C", "Cadmium"),
    ("K", "Zinc nickel"),
    ("N", "Electroless nickel"),
    ("P", "Passivated stainless steel"),
    ("T", "Nickel fluorocarbon polymer"),
]
#: Expected inserts by document key.
INSERTS = {"1": "ABCDEFGH", "2": "ABCDEFGHJK", "3": "ABCDEFGH", "4": "ABCDEFGHJK", "6": "ABCDEFG", "7": "ABCDEFG", "8": "ABCDEFG", "9": "ABCDEFG"}
#: Expected finishes by document key.
EXPECTED_FINISHES = {"1": "ACKNPT", "2": "ACKNPT", "3": "ACKNPT", "4": "ACKNPT", "6": "", "7": "", "8": "", "9": ""}
CONFIG_COUNTS = {"01": 48, "02": 60, "03": 48, "04": 60, "06": 7, "07": 7, "08": 7, "09": 7}
WIRE_COUNTS = {"03": 2784, "04": 3480, "08": 154, "09": 406}
CLASS_P = ["06", "07", "08", "09"]
CLASS_M = ["01", "02", "03", "04"]
#: Sheets that take their torque from /05, and board sheets that share one profile.
INHERITING = CLASS_M + ["06", "07", "09"]
BOARD = [str(n) for n in range(10, 34)]
#: context, thread, scope, low, high of the audited torque tables.
TORQUE_TABLE = [
    ("mounting_torque", "#2-56", "Metal shell", 3.0, 4.0),
    ("mounting_torque", "#2-56", "Plastic shell", 2.25, 2.75),
    ("mounting_torque", "#4-40", "Metal shell", 5.0, 6.0),
    ("mating_torque", "#2-56", "Metal shell", 1.0, 2.5),
    ("mating_torque", "#2-56", "Plastic shell", 1.0, 1.75),
    ("mating_torque", "#4-40", "Metal shell", 4.0, 4.5),
]
#: Dash numbers of the hardware sheet by configuration scope, with their thread.
HARDWARE = [("A/B", "#2-56", ["02", "03", "05", "06", "07"]), ("C", "#4-40", ["12", "13", "15", "16", "17"])]
MAIN, PCB, PROVISIONAL = "m83513_05_main", "m83513_pcb_shared", "m83513_08_provisional"
#: low, high, profile, mapping, mode, audit status of sheets in a range.
PROFILE_RULES = [
    (5, 5, MAIN, "uses_profile", "owns_profile", "verified"),
    (1, 4, MAIN, "references_profile", "references_other_doc", "pending"),
    (6, 7, MAIN, "references_profile", "references_other_doc", "pending"),
    (9, 9, MAIN, "references_profile", "references_other_doc", "pending"),
    (10, 33, PCB, "provisional_profile", "uses_shared_profile", "pending"),
    (8, 8, PROVISIONAL, "provisional_profile", "needs_review", "needs_review"),
]
#: code, kind, truth level, status, approval, sheet that governs.
PROFILES = [
    (MAIN, "canonical", "audited_pdf_table", "verified", "approved", "05"),
    (PCB, "shared_derived", "extracted_numeric_text", "provisional", "pending", "10"),
    (PROVISIONAL, "provisional", "extracted_numeric_text", "provisional", "needs_review", "08"),
]
#: type, required fields, expected headers, cavities, least configuration rows, inserts and wires, by document class.
DOCUMENT_CLASSES = {
    "base_spec": ("base_spec", "spec_sheet revision title", "REQUIREMENTS,DIMENSIONS,ORDERING DATA", [], 0, 0, 0),
    "hardware": ("mounting_hardware", "spec_sheet revision title mates_with", "FIGURE,REQUIREMENTS", [], 0, 0, 0),
    "solder": ("plug_receptacle", "spec_sheet revision title connector_type cavity_counts dimensions mates_with", "REQUIREMENTS,DIMENSIONS,FIGURE", CAVITIES, 8, 8, 0),
    "solder_p": ("plug_receptacle", "spec_sheet revision title connector_type cavity_counts dimensions mates_with", "REQUIREMENTS,DIMENSIONS,FIGURE", CAVITIES[:-1], 7, 7, 0),
    "crimp": ("plug_receptacle", "spec_sheet revision title connector_type cavity_counts dimensions mates_with", "HOW TO ORDER,DIMENSIONS,FIGURE", CAVITIES, 8, 8, 18),
    "crimp_p": ("plug_receptacle", "spec_sheet revision title connector_type cavity_counts dimensions mates_with", "DIMENSIONS,FIGURE", CAVITIES[:-1], 7, 7, 18),
    "pcb": ("pcb_tail", "spec_sheet revision title connector_type cavity_counts mates_with example_parts", "REQUIREMENTS,FIGURE,DIMENSIONS", [], 1, 1, 0),
}
CLASS_OF_KEY = {"base": "base_spec", "5": "hardware", "1": "solder", "2": "solder", "6": "solder_p", "7": "solder_p", "3": "crimp", "4": "crimp", "8": "crimp_p", "9": "crimp_p"}
#: Allowed steps between torque modes. Any mode may go to none after a review.
TRANSITIONS = [
    ("none", "references_other_doc"),
    ("none", "uses_shared_profile"),
    ("none", "owns_profile"),
    ("none", "needs_review"),
    ("references_other_doc", "uses_shared_profile"),
    ("references_other_doc", "owns_profile"),
    ("uses_shared_profile", "owns_profile"),
    ("uses_shared_profile", "needs_review"),
    ("needs_review", "references_other_doc"),
    ("needs_review", "uses_shared_profile"),
    ("needs_review", "owns_profile"),
    ("references_other_doc", "none"),
    ("uses_shared_profile", "none"),
    ("owns_profile", "none"),
    ("needs_review", "none"),
]


def finishes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FINISHES, "code string, description string")


def profile_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PROFILE_RULES, "lo int, hi int, profile_code string, mapping_type string, torque_mode string, audit_status string")


def transitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TRANSITIONS, "from_state string, to_state string")


def document_classes(spark: SparkSession) -> DataFrame:
    rows = [(k, t, req.split(), heads.split(","), cav, a, b, c) for k, (t, req, heads, cav, a, b, c) in DOCUMENT_CLASSES.items()]
    return spark.createDataFrame(
        rows,
        "class string, document_type string, required array<string>, expected_headers array<string>, expected_cavities array<int>, min_configs int, min_inserts int, min_wires int",
    )


def expected_codes(spark: SparkSession) -> DataFrame:
    rows = [(k, list(INSERTS[k]), list(EXPECTED_FINISHES[k])) for k in INSERTS]
    return spark.createDataFrame(rows, "key string, expected_inserts array<string>, expected_finishes array<string>")


def hardware_options(spark: SparkSession) -> DataFrame:
    rows = [(d, scope, thread) for scope, thread, dashes in HARDWARE for d in dashes]
    return spark.createDataFrame(rows, "dash string, scope string, thread string")
