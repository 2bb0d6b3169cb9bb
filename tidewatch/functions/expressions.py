"""Scalar column expressions (all built-in, all inside whole-stage codegen).

Spark 4 runs ANSI arithmetic: x / 0 raises. Every ratio therefore goes
through ``try_divide`` so a zero (or a -1 + 1) denominator yields NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Threat-level and confidence bands, recommended actions.
THREAT_LEVELS = ["Critical", "High", "Medium", "Low", "Minimal"]
THREAT_EDGES = [(0.8, "Critical"), (0.6, "High"), (0.4, "Medium"), (0.2, "Low")]
CONFIDENCE_LEVELS = ["High", "Medium", "Low"]
CONFIDENCE_EDGES = [(0.4, "High"), (0.2, "Medium")]
RECOMMENDED_ACTIONS = {
    "Critical": "Immediate isolation and investigation required",
    "High": "Priority investigation and monitoring",
    "Medium": "Enhanced monitoring and logging",
    "Low": "Standard monitoring",
    "Minimal": "Continue normal operations",
}
UNKNOWN_ACTION = "Unknown threat level"

# Rule-based detector (predicate, weight), and its cut-off.
RULES = [
    ("serror_rate", ">", 0.5, 0.3),
    ("rerror_rate", ">", 0.3, 0.2),
    ("num_failed_logins", ">", 2, 0.4),
    ("hot", ">", 3, 0.3),
    ("num_compromised", ">", 0, 0.5),
    ("root_shell", "=", 1, 0.4),
    ("duration", ">", 100, 0.1),
]
RULE_CUTOFF = 0.4


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(a, b, default=None) -> Column:
    """a / b; NULL (or ``default``) when b is 0/NULL."""
    q = F.try_divide(col(a).cast("double"), col(b).cast("double"))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def derive_label(attack_type="attack_type") -> Column:
    """1 unless the type is exactly 'normal' (a NULL type counts as attack)."""
    return (~col(attack_type).eqNullSafe(F.lit("normal"))).cast("int")


def flag(cond: Column) -> Column:
    """bool -> 0/1 with NULL comparisons counted as 0 (pandas semantics)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def rule_score(columns: list[str], rules=RULES) -> Column:
    """Weighted sum of threshold predicates over the columns present."""
    parts = []
    for name, op, thr, w in rules:
        if name not in columns:
            continue
        c = F.col(name)
        pred = c > F.lit(thr) if op == ">" else c == F.lit(thr)
        parts.append(F.when(pred, F.lit(w)).otherwise(F.lit(0.0)))
    total = F.lit(0.0)
    for p in parts:
        total = total + p
    return total


def rule_label(score: Column, cutoff: float = RULE_CUTOFF) -> Column:
    return (score > F.lit(cutoff)).cast("int")


def threat_level(p="probability") -> Column:
    p = col(p)
    e = F.when(p >= F.lit(THREAT_EDGES[0][0]), F.lit(THREAT_EDGES[0][1]))
    for edge, name in THREAT_EDGES[1:]:
        e = e.when(p >= F.lit(edge), F.lit(name))
    return F.when(p.isNull(), F.lit(None).cast("string")).otherwise(
        e.otherwise(F.lit("Minimal")))


def confidence_band(p="probability") -> Column:
    d = F.abs(col(p) - F.lit(0.5))
    e = F.when(d >= F.lit(CONFIDENCE_EDGES[0][0]), F.lit(CONFIDENCE_EDGES[0][1]))
    for edge, name in CONFIDENCE_EDGES[1:]:
        e = e.when(d >= F.lit(edge), F.lit(name))
    return F.when(col(p).isNull(), F.lit(None).cast("string")).otherwise(
        e.otherwise(F.lit("Low")))


def recommended_action(level="threat_level") -> Column:
    m = F.create_map(*[x for k, v in RECOMMENDED_ACTIONS.items()
                       for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, col(level)), F.lit(UNKNOWN_ACTION))


def prediction_label(pred="prediction") -> Column:
    """1 -> 'Attack', other values -> 'Normal'; no prediction -> NULL."""
    return F.when(col(pred).isNull(), F.lit(None).cast("string")) \
        .when(col(pred) == 1, F.lit("Attack")).otherwise(F.lit("Normal"))


def prediction_from_probability(p="probability", threshold: float = 0.5) -> Column:
    return F.when(col(p).isNull(), F.lit(None).cast("int")).otherwise(
        (col(p) >= F.lit(threshold)).cast("int"))


# Attack name -> family (the KDD Cup 1999 category assignment of
# its 22 training attack names; family names as the reference spells them).
ATTACK_FAMILIES = {
    "back": "dos", "land": "dos", "neptune": "dos", "pod": "dos", "smurf": "dos",
    "teardrop": "dos",
    "ipsweep": "probe", "nmap": "probe", "portsweep": "probe", "satan": "probe",
    "ftp_write": "r2l", "guess_passwd": "r2l", "imap": "r2l", "multihop": "r2l",
    "phf": "r2l", "spy": "r2l", "warezclient": "r2l", "warezmaster": "r2l",
    "buffer_overflow": "u2r", "loadmodule": "u2r", "perl": "u2r", "rootkit": "u2r",
}
FAMILIES = ["normal", "dos", "probe", "r2l", "u2r"]


def attack_family(attack_type="attack_type") -> Column:
    """Family of an attack name (a family name maps to itself); unknown names
    give 'unknown', NULL stays NULL. A literal map lookup: a projection."""
    pairs = dict(ATTACK_FAMILIES)
    pairs.update({f: f for f in FAMILIES})
    m = F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), F.lit(v))])
    t = F.lower(F.trim(col(attack_type)))
    return F.when(t.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.try_element_at(m, t), F.lit("unknown")))
