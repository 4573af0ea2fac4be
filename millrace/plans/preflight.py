"""Checks of a source server's settings and grants, as a pure function of what it reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from millrace.functions.text import version_at_least

OLDEST_SERVER, LEAST_RETENTION_S = "8.0.1", 86_400
# Settings that must have a value, whether a wrong one is fatal, and the reason.
REQUIRED = (
    ("log_bin", "ON", True, "the binary log must be on"),
    ("binlog_format", "ROW", True, "statements cannot be applied"),
    ("binlog_row_image", "FULL", True, "a partial image cannot fill a document"),
    ("binlog_row_metadata", "FULL", True, "column names come from the log"),
    ("gtid_mode", "ON", True, "a position must survive a failover"),
    ("enforce_gtid_consistency", "ON", False, "unsafe statements make positions that are hard to follow"),
)
GRANTS = ("REPLICATION SLAVE", "REPLICATION CLIENT", "SELECT")


class Check(NamedTuple):
    name: str
    ok: bool
    fatal: bool
    detail: str


def evaluate(variables: Mapping[str, str], grants: Sequence[str]) -> list[Check]:
    """Fourteen checks; warnings are not fatal. A setting that the server does not report is one it does not know."""
    got = {k.lower(): str(v).strip() for k, v in variables.items()}
    version = got.get("version")
    fits = version is not None and "mariadb" not in version.lower() and version_at_least(version, OLDEST_SERVER)
    out = [Check("server_version", fits, True, f"{version or 'unknown'}, wanted {OLDEST_SERVER} or later; other forks name positions in another way")]
    for name, wanted, fatal, why in REQUIRED:
        value = got.get(name)
        out.append(Check(name, value is not None and value.upper() == wanted, fatal, f"{'not known to the server' if value is None else value}: {why}"))
    partial = got.get("binlog_row_value_options", "")
    out.append(Check("binlog_row_value_options", partial == "", True, f"{partial or 'empty'}: partial JSON is a difference, not a value"))
    number = lambda k: int(got[k]) if got.get(k, "").isdigit() else None
    server = number("server_id")
    out.append(Check("server_id", server is not None and 0 < server < 1 << 32, True, "must be set and unique"))
    kept = number("binlog_expire_logs_seconds")
    enough = kept is not None and (kept == 0 or kept >= LEAST_RETENTION_S)
    out.append(Check("log_retention", enough, False, f"{'unknown' if kept is None else 'for ever' if kept == 0 else f'{kept} s'}; a scan must end before the log it starts from is purged"))
    out.append(Check("log_replica_updates", got.get("log_replica_updates", "").upper() == "ON", False, "needed only when the source is itself a replica"))
    lines = [g.upper() for g in grants if g.strip().upper().startswith("GRANT")]
    for grant in GRANTS:
        held = any(grant in line or "ALL PRIVILEGES" in line for line in lines)
        out.append(Check(f"grant {grant.lower()}", held, True, "granted" if held else "missing"))
    return out


def passed(checks: Sequence[Check]) -> bool:
    return all(c.ok or not c.fatal for c in checks)
