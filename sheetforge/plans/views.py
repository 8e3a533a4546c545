"""The serving views by name: those of a family's catalog, and those of its active release."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.torque import effective, resolve
from . import release

#: The sheets whose configurations have a view of their own, the sheet whose wires have one, and the
#: start of the family's profile codes (`_` is a wildcard there).
SHEETS = ("01", "02", "03", "04", "base")
WIRED = "03"
PROFILES = "m83513_%"


def family_views(tables: dict[str, DataFrame], family: str = "83513") -> dict[str, DataFrame]:
    """The 14 views of one family by name, all lazy; order is the reader's.

    tables: documents, configurations (config_id), extraction_runs, wire_options (config_id), torque_values, torque_status, torque_map,
    torque_profiles (profile_code), torque_facts and torque_evidence, the last five as `resolve` takes them; all but
    wire_options and the last four have spec_family.
    """
    own = lambda name: tables[name].where(F.col("spec_family") == family)
    configs, profiles, facts = own("configurations"), tables["torque_profiles"], tables["torque_facts"]
    resolved = resolve(own("torque_status"), tables["torque_map"], profiles, facts, tables["torque_evidence"])
    sheet = lambda s: configs.where(F.col("slash_sheet") == s)
    return {
        "documents": own("documents"),
        "configurations": configs,
        **{f"{s}_configurations": sheet(s) for s in SHEETS},
        "extraction_runs": own("extraction_runs"),
        f"{WIRED}_wire_options": sheet(WIRED).join(tables["wire_options"], "config_id"),
        "torque_values": own("torque_values"),
        "torque_document_summary": own("torque_status"),
        "torque_profile_values": profiles.where(F.col("profile_code").like(PROFILES)).join(facts, "profile_id"),
        "torque_resolution": resolved,
        "torque_effective_facts": effective(resolved.drop("is_active"), profiles, facts),
    }


def current_views(tables: dict[str, DataFrame], pointer: DataFrame) -> dict[str, DataFrame]:
    """The four views of the active releases by name. tables: documents, configurations, wire_options, profile_links,
    torque_profiles and torque_facts; pointer: (spec_family, release_id), a row a family."""
    docs, configs = tables["documents"], tables["configurations"]
    return {
        "configurations_current": release.current(configs, pointer),
        "wire_options_current": release.current_children(tables["wire_options"], configs, pointer),
        "torque_effective_current": release.current_torque(tables["profile_links"], docs, tables["torque_profiles"], tables["torque_facts"], pointer),
        "documents_current": release.current_documents(docs, configs, pointer),
    }
