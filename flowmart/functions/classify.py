"""Column expressions for the business classifications of the mart.

All are plain ``CASE`` chains (JVM-side, inside whole-stage codegen). The lists below are
values the results must reproduce exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Service category and risk level by service name.
SERVICE_CATEGORY = [
    (["http", "ftp", "smtp"], "WEB"),
    (["dns"], "NAME_SERVICE"),
    (["ssh"], "REMOTE_ACCESS"),
]
SERVICE_CATEGORY_DEFAULT = "OTHER"
SERVICE_RISK = [
    (["ssh", "ftp"], "HIGH"),
    (["http", "smtp"], "MEDIUM"),
]
SERVICE_RISK_DEFAULT = "LOW"
SERVICE_TYPE = "NETWORK"

# Protocol type and connection-state category.
PROTOCOL_TYPE = [
    (["tcp", "udp"], "TRANSPORT"),
    (["icmp"], "INTERNET"),
]
STATE_CATEGORY = [
    (["CON", "INT"], "CONNECTION"),
    (["ACC", "CLO"], "ACCESS"),
]
OTHER = "OTHER"
UNKNOWN = "UNKNOWN"

# Attack severity by category (5 = most severe), default 1.
ATTACK_SEVERITY = [
    (["Backdoors", "Shellcode", "Worms"], 5),
    (["DoS", "Exploits"], 4),
    (["Fuzzers", "Generic"], 3),
    (["Analysis", "Reconnaissance"], 2),
]
ATTACK_SEVERITY_DEFAULT = 1
NORMAL = "NORMAL"

# Port ranges (upper bounds exclusive).
SYSTEM_PORT_LIMIT = 1024
USER_PORT_LIMIT = 49152
MAX_PORT = 65535

# Calendar flags.
BUSINESS_HOURS = (9, 17)  # inclusive, weekdays only
PEAK_HOURS = [9, 10, 11, 14, 15, 16]


def lookup(col: Column, table: list[tuple[list, object]], default: object) -> Column:
    """``CASE WHEN col IN (...) THEN v ... ELSE default END``."""
    expr = None
    for values, out in table:
        cond = col.isin(*values)
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    return expr.otherwise(F.lit(default))


def service_category(service: Column) -> Column:
    return lookup(service, SERVICE_CATEGORY, SERVICE_CATEGORY_DEFAULT)


def service_risk(service: Column) -> Column:
    return lookup(service, SERVICE_RISK, SERVICE_RISK_DEFAULT)


def protocol_type(proto: Column) -> Column:
    return lookup(proto, PROTOCOL_TYPE, OTHER)


def state_category(state: Column) -> Column:
    return lookup(state, STATE_CATEGORY, OTHER)


def attack_severity(category: Column) -> Column:
    return lookup(category, ATTACK_SEVERITY, ATTACK_SEVERITY_DEFAULT).cast("int")


def port_range(port: Column) -> Column:
    return (
        F.when(port < SYSTEM_PORT_LIMIT, F.lit("SYSTEM"))
        .when(port < USER_PORT_LIMIT, F.lit("USER"))
        .otherwise(F.lit("DYNAMIC"))
    )


def is_attack_category(attack_cat: Column) -> Column:
    """Mart generation: a connection is an attack when its category is present, non-empty
    and not the NORMAL member (which the attack lookup maps to the default row)."""
    return F.coalesce(attack_cat.isNotNull() & ~attack_cat.isin("", NORMAL), F.lit(False))
