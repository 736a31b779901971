"""Parameters of the engine: plain values on the driver, folded into plans as literals."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Rule ids, parameter names, thresholds and sweep grids are part of the results.
RULE_PARAMS: dict[str, dict[str, float]] = {
    "R01_STRUCTURING": {"lower_bound": 8200.0, "upper_bound": 9999.0, "min_txn_count": 3.0, "window_days": 10.0},
    "R02_VELOCITY": {"max_hold_hours": 72.0, "min_passthrough_ratio": 0.80, "min_amount": 5000.0},
    "R03_ROUND_DOLLAR": {"min_round_share": 0.55, "min_txn_count": 4.0, "min_amount": 1000.0},
    "R04_DORMANT_REACTIVATION": {"dormancy_days": 90.0, "min_reactivation_amount": 15000.0, "min_reactivation_txns": 2.0},
    "R05_NEW_ACCOUNT_BURST": {"account_age_days": 60.0, "min_txn_count": 6.0, "min_total_amount": 25000.0},
    "R06_COUNTERPARTY_CONCENTRATION": {"min_concentration": 0.70, "min_txn_count": 5.0, "min_total_amount": 20000.0},
    "R07_HIGH_RISK_CORRIDOR": {"min_corridor_share": 0.30, "min_corridor_amount": 10000.0, "min_txn_count": 2.0},
    "R08_CASH_INTENSITY": {"min_cash_share": 0.65, "min_cash_amount": 20000.0, "min_txn_count": 4.0},
}
#: rule -> (swept parameter, values, baseline included)
RULE_SWEEPS: dict[str, tuple[str, tuple[float, ...]]] = {
    "R01_STRUCTURING": ("min_txn_count", (2.0, 3.0, 4.0, 5.0, 6.0, 8.0)),
    "R02_VELOCITY": ("min_passthrough_ratio", (0.60, 0.70, 0.80, 0.85, 0.90, 0.95)),
    "R03_ROUND_DOLLAR": ("min_round_share", (0.35, 0.45, 0.55, 0.65, 0.75, 0.85)),
    "R04_DORMANT_REACTIVATION": ("min_reactivation_amount", (5000.0, 10000.0, 15000.0, 25000.0, 40000.0, 60000.0)),
    "R05_NEW_ACCOUNT_BURST": ("min_total_amount", (10000.0, 20000.0, 25000.0, 40000.0, 60000.0, 90000.0)),
    "R06_COUNTERPARTY_CONCENTRATION": ("min_concentration", (0.50, 0.60, 0.70, 0.80, 0.90, 0.95)),
    "R07_HIGH_RISK_CORRIDOR": ("min_corridor_share", (0.15, 0.20, 0.30, 0.40, 0.55, 0.70)),
    "R08_CASH_INTENSITY": ("min_cash_share", (0.40, 0.50, 0.65, 0.75, 0.85, 0.95)),
}
SCREENING_GRID = (0.70, 0.74, 0.78, 0.80, 0.82, 0.84, 0.86, 0.88, 0.90, 0.92, 0.94)
DOMAINS = {
    "channel": ("WIRE", "ACH", "CARD", "CASH"),
    "direction": ("CREDIT", "DEBIT"),
    "script": ("LATIN", "ARABIC", "CYRILLIC", "HAN"),
}


@dataclass(frozen=True)
class Scenario:
    """A monitoring rule with its parameters and what a sweep varies."""

    rule_id: str
    params: dict[str, float]
    sweep_param: str
    sweep_values: tuple[float, ...]

    def with_param(self, name: str, value: float) -> Scenario:
        if name not in self.params:
            raise KeyError(f"{self.rule_id} has no parameter {name}")
        return replace(self, params={**self.params, name: float(value)})

    @property
    def grid(self) -> list[float]:
        """Sweep values and the baseline, ascending."""
        return sorted({*self.sweep_values, self.params[self.sweep_param]})


def scenarios() -> dict[str, Scenario]:
    return {r: Scenario(r, dict(p), *RULE_SWEEPS[r]) for r, p in RULE_PARAMS.items()}


@dataclass(frozen=True)
class Screening:
    """Name screening parameters."""

    jaro_winkler: float = 0.42
    token_set: float = 0.24
    phonetic: float = 0.22
    initials: float = 0.12
    prefix_weight: float = 0.1
    dob_exact: float = 0.14
    dob_year_only: float = 0.05
    dob_mismatch: float = -0.14
    nationality_match: float = 0.06
    nationality_mismatch: float = -0.05
    id_exact: float = 0.30
    single_token: float = -0.10
    strong_name_floor: float = 0.95
    strong_name_floor_score: float = 0.80
    escalate: float = 0.92
    review: float = 0.86
    max_block: int = 250
    prefilter: float = 0.62
    shortlist: int = 40
    min_token: int = 2
    strategies: tuple[str, ...] = ("PS", "SP", "IB")
    drop_single_char: bool = False
    # Words removed from names before comparison.
    honorifics: frozenset[str] = field(default=frozenset(
        "mr mrs ms miss dr prof sir madam hon rev sheikh shaikh sayyid sayed hajji haji al-hajj mullah imam general gen colonel col captain "
        "capt major maj lt lieutenant eng engineer mohtaram ustad don dona sr sra srta herr frau".split()
    ))
    legal_forms: frozenset[str] = field(default=frozenset(
        "llc ltd limited inc incorporated corp corporation gmbh ag sa sarl bv nv plc pte pty co company oao ooo zao pjsc jsc kft spa srl as ab oy".split()
    ))
    particles: frozenset[str] = field(default=frozenset(
        "al el ul bin ibn bint binti ben abu umm van von der den de del della di da dos das du la le les of the and y e".split()
    ))


@dataclass(frozen=True)
class Monitoring:
    """Split, evaluation and single-transaction parameters."""

    test_share: float = 0.25
    out_of_time_months: int = 3
    target_recall: float = 0.85
    alert_budget: float = 0.05
    shrink_prior: float = 3.0
    near_ctr_cash: tuple[float, float] = (8200.0, 9900.0)
    ctr: float = 10000.0
    supervised_ceiling: float = 0.92
    unsupervised_ceiling: float = 0.93
    floor_warning: float = 0.70
    separability_band: float = 0.08


def from_yaml(path: str) -> dict[str, Scenario]:
    """Scenarios from a YAML file: ``scenarios: {RULE: {params: {...}, sweep: {param: ..., values: [...]}}}``.

    Unknown rules, missing parameters and a sweep without its baseline's parameter are errors.
    """
    import yaml

    with open(path, encoding="utf-8") as f:
        raw = yaml.safe_load(f)
    if not isinstance(raw, dict) or "scenarios" not in raw:
        raise ValueError(f"{path}: no scenarios")
    out = {}
    for rule, body in raw["scenarios"].items():
        if rule not in RULE_PARAMS:
            raise ValueError(f"{path}: unknown rule {rule}")
        params = {k: float(v) for k, v in (body.get("params") or {}).items()}
        if missing := RULE_PARAMS[rule].keys() - params.keys():
            raise ValueError(f"{path}: {rule} lacks {sorted(missing)}")
        sweep = body.get("sweep") or {"param": RULE_SWEEPS[rule][0], "values": RULE_SWEEPS[rule][1]}
        if sweep["param"] not in params:
            raise ValueError(f"{path}: {rule} sweeps {sweep['param']}, which it hasn't")
        out[rule] = Scenario(rule, params, sweep["param"], tuple(float(v) for v in sweep["values"]))
    return out
