"""DuckDB statements that say directly what each query means, for the driver's comparison.

They share nothing with the Spark code but the fixed values: counts are plain joins with
``count(DISTINCT ...)``, quantiles are ``row_number``, the lower bound is a bisection over a
power series, and the truncated sums are written out.
"""

from __future__ import annotations

from pairsignal.fixtures import DEMO_HEADER, DRUG_HEADER, REACT_HEADER
from pairsignal.operators.fit import PLAIN_START, random_starts
from pairsignal.schema import DEFAULT_PARAMS, FULL_STRATA, YEAR_STRATA

SEX = "CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' ELSE 'U' END"
AGE = "CAST(o_custkey % 110 AS VARCHAR)"

SOURCES = f"""
demo_lines AS (
  SELECT o_orderkey || '$' || (o_orderkey // 2) || '$$$$$$'
    || (year(o_orderdate) + 11) || strftime(o_orderdate, '%m%d') || '$$$$'
    || CASE WHEN o_orderkey % 17 = 0 THEN 'abc'
            WHEN o_orderkey % 29 = 0 THEN {AGE} || '.7' ELSE {AGE} END || '$'
    || CASE WHEN o_orderkey % 19 = 0 THEN 'MON' ELSE 'YR' END || '$'
    || CASE WHEN o_orderkey % 23 = 0 THEN lower({SEX}) ELSE {SEX} END AS value
  FROM orders UNION ALL SELECT '{DEMO_HEADER}'),
drug_lines AS (
  SELECT l_orderkey || '$' || l_linenumber || '$$' || p_brand AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey UNION ALL SELECT '{DRUG_HEADER}'),
react_lines AS (
  SELECT l_orderkey || '$' || n_name AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT '{REACT_HEADER}'),
demo_fields AS (
  SELECT TRY_CAST(f[1] AS BIGINT) AS isr, TRY_CAST(f[2] AS BIGINT) AS case_id, f[8] AS fda_dt,
    CAST(trunc(TRY_CAST(f[12] AS FLOAT)) AS BIGINT) AS age, f[13] AS age_cod, f[14] AS gender,
    len(f) AS n_fields
  FROM (SELECT string_split(rtrim(value, '$'), '$') AS f FROM demo_lines)),
demo_flags AS (
  SELECT *, coalesce(n_fields >= 14 AND isr IS NOT NULL AND case_id IS NOT NULL
    AND upper(age_cod) = 'YR' AND upper(gender) IN ('M', 'F')
    AND TRY_CAST(substr(fda_dt, 1, 4) AS INTEGER) >= 2008 AND age > 0 AND age <= 100, false) AS valid
  FROM demo_fields),
demo AS (SELECT isr, case_id, fda_dt, age, age_cod, gender FROM demo_flags WHERE valid),
drug AS (
  SELECT TRY_CAST(f[1] AS BIGINT) AS isr, f[2] AS drug_seq, f[4] AS drug
  FROM (SELECT string_split(rtrim(value, '$'), '$') AS f FROM drug_lines)
  WHERE len(f) >= 4 AND TRY_CAST(f[1] AS BIGINT) IS NOT NULL),
react AS (
  SELECT TRY_CAST(f[1] AS BIGINT) AS isr, f[2] AS react
  FROM (SELECT string_split(rtrim(value, '$'), '$') AS f FROM react_lines)
  WHERE len(f) >= 2 AND TRY_CAST(f[1] AS BIGINT) IS NOT NULL),
report AS (
  SELECT *, CAST(substr(fda_dt, 1, 4) AS INTEGER) AS fda_year FROM (
    SELECT *, row_number() OVER (
      PARTITION BY case_id ORDER BY isr, fda_dt, age, age_cod, gender) AS version FROM demo)
  WHERE version = 1),
pair AS (
  SELECT DISTINCT a.isr, a.drug AS drug1, b.drug AS drug2
  FROM drug a JOIN drug b ON a.isr = b.isr AND a.drug < b.drug),
joined AS (
  SELECT drug, react, isr, gender, age, fda_dt, fda_year
  FROM report JOIN drug USING (isr) JOIN react USING (isr)),
joined_pairs AS (
  SELECT drug1, drug2, react, isr, gender, age, fda_dt, fda_year
  FROM report JOIN react USING (isr) JOIN pair USING (isr))"""


def _count(strata: tuple[str, ...], keys: str, out: str, table: str = "joined") -> str:
    by = ", ".join([*strata, *([keys] if keys else [])])
    return f"SELECT {by}, count(DISTINCT isr) AS {out} FROM {table} GROUP BY {by}"


def _marginals(strata: tuple[str, ...]) -> str:
    """CTEs up to ``marginal`` and ``triple`` for the given strata."""
    s = ", ".join(strata)
    on = lambda t: " AND ".join(f"p.{c} = {t}.{c}" for c in strata)
    return f"""{SOURCES},
n_s AS ({_count(strata, '', 'n_stratum')}),
n_d AS ({_count(strata, 'drug', 'n_drug')}),
n_r AS ({_count(strata, 'react', 'n_react')}),
n_p AS ({_count(strata, 'drug1, drug2, react', 'n', 'joined_pairs')}),
marginal AS (
  SELECT {', '.join('p.' + c for c in strata)}, drug1, drug2, p.react, n, n_stratum,
    d1.n_drug AS n_drug1, d2.n_drug AS n_drug2, n_react
  FROM n_p p JOIN n_s s ON {on('s')}
  JOIN n_d d1 ON {on('d1')} AND d1.drug = drug1
  JOIN n_d d2 ON {on('d2')} AND d2.drug = drug2
  JOIN n_r r ON {on('r')} AND r.react = p.react),
by_stratum AS (
  SELECT *, CAST(n_drug1 AS DOUBLE) * n_drug2 * n_react / (CAST(n_stratum AS DOUBLE) * n_stratum) AS expected
  FROM marginal),
every_triple AS (
  SELECT drug1, drug2, react, CAST(sum(n) AS BIGINT) AS actual, sum(expected) AS expected
  FROM by_stratum GROUP BY ALL)"""


YEARLY = _marginals(YEAR_STRATA)
# Exposures rounded against ulps in ties, as the queries do.
TRIPLES = f"""{YEARLY},
triple AS (
  SELECT drug1, drug2, react, actual, round(expected, 9) AS expected
  FROM every_triple WHERE actual >= 3)"""

# As computed, for the queries that score without a rounding step.
EXACT_TRIPLES = f"""{YEARLY},
triple AS (SELECT * FROM every_triple WHERE actual >= 3)"""

_RANK = lambda i: f"max(CASE WHEN place = (n_group * {i} + 9) // 10 THEN expected END) AS q{i}"
CUTS = f"""{TRIPLES},
cuts AS (
  SELECT actual, n_group, min(expected) AS q0, {', '.join(_RANK(i) for i in range(1, 10))},
    max(expected) AS q10
  FROM (SELECT actual, expected, count(*) OVER (PARTITION BY actual) AS n_group,
          row_number() OVER (PARTITION BY actual ORDER BY expected) AS place FROM triple)
  GROUP BY actual, n_group)"""


def _search(low: int, high: int) -> str:
    if low > high:
        return str(low)
    mid = (low + high) // 2
    return (
        f"CASE WHEN expected < q{mid} THEN {_search(low, mid - 1)} "
        f"WHEN expected > q{mid} THEN {_search(mid + 1, high)} ELSE {mid} END"
    )


SQUASHED = f"""{CUTS},
binned AS (
  SELECT drug1, drug2, react, actual, expected, {_search(0, 10)} AS bin
  FROM triple JOIN cuts USING (actual)),
squashed AS (
  SELECT actual, bin, sum(expected) AS sum_expected, count(*) AS weight FROM binned GROUP BY ALL),
cell AS (
  SELECT actual AS n, weight AS w, sum_expected / weight AS e FROM squashed WHERE bin >= 1)"""

P, D = PLAIN_START, DEFAULT_PARAMS


def _ln_f(n: str, e: str, a: float, b: float) -> str:
    return (
        f"(-({n}) * ln(1 + {b} / {e}) - {a} * ln(1 + {e} / {b})"
        f" + lgamma({a} + {n}) - lgamma({a}) - lgamma({n} + 1))"
    )


def _digamma(x: str) -> str:
    z = f"({x} + 30)"
    tail = " + ".join(f"1 / ({x} + {k})" for k in range(30))
    return f"(ln({z}) - 1 / (2 * {z}) - 1 / (12 * {z}**2) + 1 / (120 * {z}**4) - 1 / (252 * {z}**6) - ({tail}))"


ODDS = f"exp({_ln_f('actual', 'expected', P.alpha2, P.beta2)} - {_ln_f('actual', 'expected', P.alpha1, P.beta1)} + ln({(1 - P.p) / P.p}))"
WEIGHT = f"1 / (1 + {ODDS})"


def _delta(a: float, b: float) -> str:
    return f"{_digamma(f'(actual + {a})')} - ln({b} + expected)"


# With p = 1 the bound is a gamma quantile at shape actual + alpha1 times a scale, so one
# bisection per actual count is enough.
QUANTILE = f"""
shapes AS (SELECT DISTINCT actual, actual + {D.alpha1} AS a FROM triple),
search AS (
  SELECT actual, a, 0 AS step, 0.0::DOUBLE AS low, CAST(a AS DOUBLE) AS high FROM shapes
  UNION ALL
  SELECT actual, a, step + 1,
    CASE WHEN below < 0.05 THEN mid ELSE low END, CASE WHEN below < 0.05 THEN high ELSE mid END
  FROM (SELECT *, list_sum(list_transform(range(0, 800), lambda k:
          exp((a + k) * ln(mid) - mid - lgamma(a + k + 1)))) AS below
        FROM (SELECT *, (low + high) / 2 AS mid FROM search WHERE step < 55))),
bound AS (SELECT actual, (low + high) / 2 AS y FROM search WHERE step = 55)"""


def _bounds_of(out: str, scale: str) -> str:
    """Bisection over both components of the plain mixture, step by step for each triple."""
    part = lambda a, x: (
        f"CASE WHEN {x} > {a} + 12 * sqrt({a}) + 60 THEN 1.0 ELSE list_sum(list_transform(range(0, 260), "
        f"lambda k: exp(({a} + k) * ln({x}) - {x} - lgamma({a} + k + 1)))) END"
    )
    return f"""{out}_search AS (
  SELECT actual, expected, q, s1, s2, 0 AS step, 0.0::DOUBLE AS low,
    greatest((actual + {P.alpha1}) * s1, (actual + {P.alpha2}) * s2) / 0.95 AS high
  FROM (SELECT DISTINCT actual, expected, {WEIGHT} AS q, {scale.format(b=P.beta1)} AS s1, {scale.format(b=P.beta2)} AS s2 FROM triple)
  UNION ALL
  SELECT actual, expected, q, s1, s2, step + 1,
    CASE WHEN below < 0.05 THEN mid ELSE low END, CASE WHEN below < 0.05 THEN high ELSE mid END
  FROM (SELECT *, q * {part(f"(actual + {P.alpha1})", "(mid / s1)")} + (1 - q) * {part(f"(actual + {P.alpha2})", "(mid / s2)")} AS below
        FROM (SELECT *, (low + high) / 2 AS mid FROM {out}_search WHERE step < 40))),
{out}_found AS (SELECT actual, expected, (low + high) / 2 AS {out} FROM {out}_search WHERE step = 40)"""


EBGM = f"exp({_delta(D.alpha1, D.beta1)})"
EBGM_MIXED = f"exp({WEIGHT} * ({_delta(P.alpha1, P.beta1)}) + (1 - {WEIGHT}) * ({_delta(P.alpha2, P.beta2)}))"
EBCI = {
    "scale": f"CASE WHEN y * ({D.beta1} + expected) > 10 THEN -1.0 ELSE y * ({D.beta1} + expected) END",
    "rate": f"y / ({D.beta1} + expected)",
}


def _recursive(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes} {select}"


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


TRIPLE_COLUMNS = "drug1, drug2, react, actual, round(expected, 6) AS expected"


def _scored(posterior: str, limit: float) -> str:
    return f"""{EXACT_TRIPLES}, {QUANTILE},
signal AS (
  SELECT {TRIPLE_COLUMNS}, round(actual / expected, 6) AS rrr, round({EBGM}, 6) AS ebgm,
    round(ebci, 6) AS ebci
  FROM (SELECT *, {EBCI[posterior]} AS ebci FROM triple JOIN bound USING (actual))
  WHERE ebci >= {limit})"""


NETWORK = f"""{_scored('rate', 1.0)},
renamed AS (
  SELECT CASE WHEN drug1 = 'Brand#1' THEN 'Brand#1/Brand#2' ELSE drug1 END AS drug1,
    CASE WHEN drug2 = 'Brand#1' THEN 'Brand#1/Brand#2' ELSE drug2 END AS drug2,
    react, actual, expected, rrr, ebgm, ebci FROM signal),
kept AS (SELECT * FROM renamed WHERE NOT contains(drug1, '/') AND NOT contains(drug2, '/')),
label AS (SELECT drug1 AS label FROM kept UNION SELECT drug2 FROM kept),
node AS (SELECT row_number() OVER (ORDER BY label) - 1 AS id, label FROM label)"""


K = "k"  # the counted number in a lambda


def _truncated(i: int, a: float | str, b: float | str) -> dict[str, str]:
    """ln f, the sum below nstar, and the derivatives of component ``i``, written out."""
    f_k = f"exp({_ln_f('k', 'e', a, b)})"
    harmonic = lambda n: f"coalesce(list_sum(list_transform(range(0, {n}), lambda j: 1 / ({a} + j))), 0)"
    total = lambda term: f"list_sum(list_transform(range(0, nstar), lambda k: {term}))"
    by_alpha = lambda n: f"({harmonic(n)} - ln(1 + e / {b}))"
    by_beta = lambda n: f"(-{n} / ({b} + e) + {a} * e / ({b} * ({b} + e)))"
    g = f"(1 - {total(f_k)})"
    return {
        f"ln{i}": f"{_ln_f('n', 'e', a, b)} - ln({g})",
        f"da{i}": f"{by_alpha('n')} + {total(f'{f_k} * {by_alpha(K)}')} / {g}",
        f"db{i}": f"{by_beta('n')} + {total(f'{f_k} * {by_beta(K)}')} / {g}",
    }


FITTED = f"""{SQUASHED},
bottom AS (SELECT *, (SELECT min(n) FROM cell) AS nstar FROM cell),
parts AS (SELECT n, w, e, {', '.join(f'{sql} AS {c}' for c, sql in (_truncated(1, P.alpha1, P.beta1) | _truncated(2, P.alpha2, P.beta2)).items())} FROM bottom),
mixed AS (
  SELECT *, {P.p} * exp(ln1) AS x1, {1 - P.p} * exp(ln2) AS x2 FROM parts)"""


def _step() -> str:
    """One EM step: per component a scoring step in ln alpha and ln beta, its 2 x 2 solve written
    out, no longer than 2; the share in closed form."""
    sums, moves, out = [], [], []
    for i, a, b in ((1, P.alpha1, P.beta1), (2, P.alpha2, P.beta2)):
        wr, u, v = f"w * x{i} / (x1 + x2)", f"({a} * da{i})", f"({b} * db{i})"
        sums += [
            f"sum({wr} * {x}) AS {name}{i}" for name, x in
            (("u", u), ("v", v), ("uu", f"{u} * {u}"), ("uv", f"{u} * {v}"), ("vv", f"{v} * {v}"))
        ]
        ridge = f"(1e-8 * (uu{i} + vv{i}) + 1e-12)"
        det = f"((uu{i} + {ridge}) * (vv{i} + {ridge}) - uv{i} * uv{i})"
        moves += [
            f"((vv{i} + {ridge}) * u{i} - uv{i} * v{i}) / {det} AS mu{i}",
            f"((uu{i} + {ridge}) * v{i} - uv{i} * u{i}) / {det} AS mv{i}",
        ]
        short = f"least(1, 2 / sqrt(mu{i} * mu{i} + mv{i} * mv{i}))"
        out += [f"round({a} * exp({short} * mu{i}), 4) AS alpha{i}", f"round({b} * exp({short} * mv{i}), 4) AS beta{i}"]
    return (
        f"SELECT {', '.join(out)}, round(p, 4) AS p, round(loglik, 4) AS loglik FROM (SELECT *, {', '.join(moves)} "
        f"FROM (SELECT {', '.join(sums)}, sum(w * x1 / (x1 + x2)) / sum(w) AS p, sum(w * ln(x1 + x2)) AS loglik FROM mixed))"
    )


# The fit as a recursive query: the same EM steps, step lengths, extrapolations and stopping rule, with
# the whole likelihood written out for each theta that is tried.  ``FIT_LIMIT`` bounds ln alpha and ln
# beta, as the queries do: the counts here are as good as Poisson, so alpha runs to any limit.
FIT_LIMIT = 8.0
THETA = ("a1", "b1", "a2", "b2", "p")
SUMS = ("loglik", "w", "wr") + tuple(f"{k}{i}" for i in (1, 2) for k in ("u", "v", "uu", "uv", "vv"))


def _struct(fields: dict[str, str]) -> str:
    return "struct_pack(" + ", ".join(f"{k} := {v}" for k, v in fields.items()) + ")"


def _sums_over_cells(source: str, keep: str) -> str:
    """The sums of each row (start, j, theta) of ``source`` over all cells, as struct ``sums``."""
    terms = _truncated(1, "a1", "b1") | _truncated(2, "a2", "b2")
    sums = {"loglik": "sum(w * ln(x1 + x2))", "w": "sum(w)", "wr": "sum(w * x1 / (x1 + x2))"}
    for i in (1, 2):
        wr, u, v = f"w * x{i} / (x1 + x2)", f"(a{i} * da{i})", f"(b{i} * db{i})"
        sums |= {f"{k}{i}": f"sum({wr} * {x})" for k, x in
                 (("u", u), ("v", v), ("uu", f"{u} * {u}"), ("uv", f"{u} * {v}"), ("vv", f"{v} * {v}"))}
    theta = _struct({k: k for k in THETA})
    return (
        f"SELECT start, j, any_value({theta}) AS theta, {keep}, {_struct(sums)} AS sums "
        f"FROM (SELECT *, p * exp(ln1) AS x1, (1 - p) * exp(ln2) AS x2 FROM (SELECT *, "
        f"{', '.join(f'{sql} AS {c}' for c, sql in terms.items())} FROM ({source}) CROSS JOIN fit_cell)) GROUP BY start, j"
    )


def _candidates() -> str:
    """The thetas to try from each active state: four step lengths, and two extrapolations after a
    whole step."""
    limit, least = FIT_LIMIT, "1e-12"
    share = f"least(greatest(s.sums.wr / s.sums.w, {least}), 1 - {least})"
    moves = []
    for i in (1, 2):
        t = lambda k: f"s.sums.{k}{i}"  # noqa: B023, E731
        ridge = f"(1e-8 * ({t('uu')} + {t('vv')}) + 1e-12)"
        det = f"(({t('uu')} + {ridge}) * ({t('vv')} + {ridge}) - {t('uv')} * {t('uv')})"
        moves += [f"(({t('vv')} + {ridge}) * {t('u')} - {t('uv')} * {t('v')}) / {det} AS mu{i}",
                  f"(({t('uu')} + {ridge}) * {t('v')} - {t('uv')} * {t('u')}) / {det} AS mv{i}"]
    short = {i: f"least(1, 2 / greatest(sqrt(mu{i} * mu{i} + mv{i} * mv{i}), 1e-300))" for i in (1, 2)}

    def bounded(la: str, lb: str) -> tuple[str, str]:
        """Logs moved together into the limits."""
        down = f"greatest(0, greatest({la}, {lb}) - {limit})"
        up = f"greatest(0, -{limit} - (least({la}, {lb}) - {down}))"
        return tuple(f"exp(least({x} - {down} + {up}, {limit}))" for x in (la, lb))

    def theta(c: float) -> dict[str, str]:
        out = {}
        for i in (1, 2):
            logs = [f"(ln(s.theta.{k}{i}) + {c} * {short[i]} * {m}{i})" for k, m in (("a", "mu"), ("b", "mv"))]
            out |= dict(zip((f"a{i}", f"b{i}"), bounded(*logs)))
        return out | {"p": share}

    steps = ", ".join(f"{_struct(theta(c))} AS step{j}" for j, c in enumerate((1.0, 0.3, 0.05, 0.0)))
    free = lambda t, k: f"ln({t}.p / (1 - {t}.p))" if k == "p" else f"ln({t}.{k})"
    coords = ", ".join(
        f"{free('s.before', k)} AS {k}_0, {free('s.theta', k)} - {free('s.before', k)} AS {k}_r, "
        f"{free('step0', k)} - 2 * {free('s.theta', k)} + {free('s.before', k)} AS {k}_v" for k in THETA)
    norm = lambda c: f"sqrt({' + '.join(f'{k}_{c} * {k}_{c}' for k in THETA)})"

    def far(c: str) -> str:
        x = {k: f"({k}_0 + 2 * {c} * {k}_r + {c} * {c} * {k}_v)" for k in THETA}
        odds = f"exp(least(greatest({x['p']}, -700), 700))"
        (a1, b1), (a2, b2) = bounded(x["a1"], x["b1"]), bounded(x["a2"], x["b2"])
        return _struct({"a1": a1, "b1": b1, "a2": a2, "b2": b2,
                        "p": f"least(greatest({odds} / (1 + {odds}), {least}), 1 - {least})"})

    tried = "list_value(step0, step1, step2, step3) || CASE WHEN reach > 1 THEN list_value(" \
        f"{far('least(reach, 16)')}, {far('((least(reach, 16) + 1) / 2)')}) ELSE [] END"
    return (
        f"SELECT start, pass, s, unnest({tried}) AS theta, generate_subscripts({tried}, 1) - 1 AS j FROM ("
        f"SELECT *, {norm('r')} / greatest({norm('v')}, 1e-300) AS reach FROM (SELECT *, {coords} FROM ("
        f"SELECT *, {steps} FROM (SELECT *, {', '.join(moves)} FROM fit WHERE s.active AND pass < 100))))"
    )


def _fit(starts: list) -> str:
    """CTEs up to ``fitted``: start, loglik, iterations, converged and at_limit of every start."""
    rows = ", ".join(
        f"({i}, 0, {', '.join(f'{float(x)!r}::DOUBLE' for x in (t.alpha1, t.beta1, t.alpha2, t.beta2, t.p))})"
        for i, t in enumerate(starts)
    )
    none = _struct({k: "NULL::DOUBLE" for k in THETA})
    first = _sums_over_cells(f"SELECT * FROM (VALUES {rows}) v(start, j, a1, b1, a2, b2, p)", "0 AS pass")
    tried = _sums_over_cells(
        f"SELECT start, j, pass, s, {', '.join(f'theta.{k} AS {k}' for k in THETA)} FROM ({_candidates()})",
        "any_value(pass) AS pass, any_value(s) AS s")
    state = {"theta": "theta", "before": none, "sums": "sums", "iterations": "0", "active": "true"}
    gain = "best.sums.loglik - s.sums.loglik"
    then = {
        "theta": f"CASE WHEN {gain} > 0 THEN best.theta ELSE s.theta END",
        "before": f"CASE WHEN {gain} > 0 AND best.j = 0 THEN s.theta WHEN {gain} > 0 THEN {none} ELSE s.before END",
        "sums": f"CASE WHEN {gain} > 0 THEN best.sums ELSE s.sums END",
        "iterations": f"s.iterations + CASE WHEN {gain} > 0 THEN 1 ELSE 0 END",
        "active": f"{gain} > 0.01",
    }
    edge = f"{FIT_LIMIT - 1e-9}"
    at_limit = " OR ".join(f"abs(ln(s.theta.{k})) >= {edge}" for k in THETA[:4])
    return f"""{SQUASHED},
fit_cell AS MATERIALIZED (
  SELECT n::BIGINT AS n, w::DOUBLE AS w, e::DOUBLE AS e, (SELECT min(n) FROM cell) AS nstar FROM cell),
fit AS (
  SELECT start, pass, {_struct(state)} AS s FROM ({first})
  UNION ALL
  SELECT start, pass + 1, {_struct(then)} AS s
  FROM (SELECT start, any_value(pass) AS pass, any_value(s) AS s,
          list({_struct({'theta': 'theta', 'sums': 'sums', 'j': 'j'})} ORDER BY sums.loglik DESC, j DESC)[1] AS best
        FROM ({tried}) GROUP BY start)),
fitted AS (
  SELECT start::INT AS start, s.sums.loglik AS loglik, s.iterations::INT AS iterations, NOT s.active AS converged,
    {at_limit} OR NOT (s.theta.p > 1e-9 AND s.theta.p < 1 - 1e-9) AS at_limit
  FROM fit QUALIFY row_number() OVER (PARTITION BY start ORDER BY pass DESC) = 1)"""


FIT_COLUMNS = "start, round(loglik, 1) AS loglik, iterations, converged, at_limit"


def _every_stage_table() -> str:
    """Rows, sum of all numbers and letters in all texts of each stage table."""
    triple = "length(drug1) + length(drug2) + length(react)"
    year, gender = "fda_year", "length(gender)"
    tables = {
        "strat_drugs1_reacs": ("joined", f"isr + {year}", f"length(drug) + length(react) + {gender}"),
        "strat_demo_counts": ("n_s", f"{year} + n_stratum", gender),
        "strat_drugs_counts": ("n_d", f"{year} + n_drug", f"{gender} + length(drug)"),
        "strat_reacs_counts": ("n_r", f"{year} + n_react", f"{gender} + length(react)"),
        "strat_drugs_reacs_counts": (
            f"({_count(YEAR_STRATA, 'drug, react', 'n')})", f"{year} + n", f"{gender} + length(drug) + length(react)"),
        "strat_drugs2_reacs": ("joined_pairs", f"isr + {year}", f"{triple} + {gender}"),
        "strat_drugs2_reacs_counts": ("n_p", f"{year} + n", f"{triple} + {gender}"),
        "drugs2_reacs_actual_expected": ("triple", "actual + round(expected, 6)", triple),
        "drugs2_reacs_stats": ("squashed", "actual + bin + round(sum_expected, 5) + weight", "0"),
        "scored_drugs2_reacs": ("signal", "actual + expected + rrr + ebgm + ebci", triple),
        "network_nodes": ("node", "id", "length(label)"),
        "network_edges": (
            "(SELECT s.id + t.id + max(ebci) AS said, sum(length(react)) AS letters FROM signal "
            "JOIN node s ON s.label = drug1 JOIN node t ON t.label = drug2 GROUP BY s.id, t.id)", "said", "letters"),
    }
    network = f"""{SQUASHED}, {QUANTILE},
signal AS (
  SELECT drug1, drug2, react, actual, round(expected, 6) AS expected, round(actual / expected, 6) AS rrr,
    round({EBGM}, 6) AS ebgm, round(ebci, 6) AS ebci
  FROM (SELECT *, {EBCI['rate']} AS ebci FROM every_triple JOIN bound USING (actual) WHERE actual >= 3)
  WHERE ebci >= 1.0),
node AS (
  SELECT row_number() OVER (ORDER BY label) - 1 AS id, label
  FROM (SELECT drug1 AS label FROM signal UNION SELECT drug2 FROM signal))"""
    return _recursive(network, " UNION ALL ".join(
        f"SELECT '{name}' AS stage_table, count(*) AS n, round(CAST(sum({numbers}) AS DOUBLE), 2) AS numbers, "
        f"CAST(coalesce(sum({letters}), 0) AS BIGINT) AS letters FROM {table}"
        for name, (table, numbers, letters) in tables.items()
    ))


def statements() -> dict[str, str]:
    full = ", ".join(FULL_STRATA)
    counted = {"demos": ("demo_lines", "demo"), "drugs": ("drug_lines", "drug"), "reactions": ("react_lines", "react")}
    line_counts = " UNION ALL ".join(
        f"SELECT '{name}' AS source, (SELECT count(*) FROM {raw}) AS raw_lines, "
        f"(SELECT count(*) FROM {ok}) AS valid_lines, "
        f"(SELECT count(*) FROM {raw}) - (SELECT count(*) FROM {ok}) AS rejected_lines"
        for name, (raw, ok) in counted.items()
    )
    rounded_cuts = _with(
        CUTS, "SELECT actual, n_group, " + ", ".join(f"round(q{i}, 6) AS q{i}" for i in range(11)) + " FROM cuts"
    )
    scores = lambda column, sql: _with(
        TRIPLES, f"SELECT {TRIPLE_COLUMNS}, round({sql}, 6) AS {column} FROM triple"
    )
    return {
        "ingest_line_counts": _with(SOURCES, line_counts),
        "parse_demo": _with(SOURCES, "SELECT * FROM demo"),
        "valid_demo_filter": _with(
            SOURCES,
            "SELECT valid, count(*) AS n, CAST(sum(age) AS BIGINT) AS sum_age FROM demo_flags GROUP BY valid",
        ),
        "parse_drug": _with(SOURCES, "SELECT * FROM drug"),
        "parse_react": _with(SOURCES, "SELECT * FROM react"),
        "dedupe_cases": _with(SOURCES, "SELECT isr, case_id, fda_dt, age, age_cod, gender FROM report"),
        "report_drug_react": _with(SOURCES, f"SELECT drug, react, isr, {full} FROM joined"),
        "distinct_report_drugs": _with(SOURCES, "SELECT DISTINCT isr, drug FROM drug"),
        "multi_drug_reports": _with(
            SOURCES,
            "SELECT isr, count(DISTINCT drug) AS n_items FROM drug GROUP BY isr HAVING count(DISTINCT drug) > 1",
        ),
        "drug_pairs": _with(SOURCES, "SELECT * FROM pair"),
        "report_pair_react": _with(SOURCES, f"SELECT drug1, drug2, react, isr, {full} FROM joined_pairs"),
        "stratum_counts": _with(SOURCES, _count(FULL_STRATA, "", "n_stratum")),
        "drug_counts": _with(SOURCES, _count(FULL_STRATA, "drug", "n_drug")),
        "react_counts": _with(SOURCES, _count(FULL_STRATA, "react", "n_react")),
        "drug_react_counts": _with(SOURCES, _count(FULL_STRATA, "drug, react", "n")),
        "pair_react_counts": _with(
            SOURCES, _count(FULL_STRATA, "drug1, drug2, react", "n", "joined_pairs")
        ),
        "pair_react_counts_by_year": _with(
            SOURCES, _count(YEAR_STRATA, "drug1, drug2, react", "n", "joined_pairs")
        ),
        "pair_marginals": _with(YEARLY, "SELECT * FROM marginal"),
        "pair_stratum_expected": _with(
            YEARLY, "SELECT * REPLACE (round(expected, 6) AS expected) FROM by_stratum"
        ),
        "actual_expected": _with(
            _marginals(FULL_STRATA), f"SELECT {TRIPLE_COLUMNS} FROM every_triple"
        ),
        "actual_expected_by_year": _with(YEARLY, f"SELECT {TRIPLE_COLUMNS} FROM every_triple"),
        "min_actual_filter": _with(YEARLY, f"SELECT {TRIPLE_COLUMNS} FROM every_triple WHERE actual >= 3"),
        "quantile_cuts": rounded_cuts,
        "quantile_cuts_approx": rounded_cuts,  # groups are smaller than the accuracy asked for
        "quantile_cuts_sketched": _with(
            TRIPLES, "SELECT actual, count(*) AS n_group, i::INT AS i, true AS within FROM triple, range(1, 10) r(i) GROUP BY actual, i"
        ),
        "ingest_line_counts_observed": _with(SOURCES, line_counts),
        "parse_demo_normalized": _with(
            SOURCES, "SELECT * REPLACE (upper(trim(gender)) AS gender, trim(fda_dt) AS fda_dt) FROM demo"
        ),
        "actual_expected_bucketed": _with(YEARLY, f"SELECT {TRIPLE_COLUMNS} FROM every_triple"),
        "every_stage_table_parquet": _every_stage_table(),
        "every_stage_table_text": _every_stage_table(),
        "binned_expected": _with(SQUASHED, f"SELECT {TRIPLE_COLUMNS}, bin FROM binned"),
        "squashed_stats": _with(
            SQUASHED, "SELECT actual, bin, round(sum_expected, 5) AS sum_expected, weight FROM squashed"
        ),
        "nb_pmf": _with(
            TRIPLES,
            f"SELECT {TRIPLE_COLUMNS}, round({_ln_f('actual', 'expected', P.alpha1, P.beta1)}, 6) AS ln_pmf1, "
            f"round({_ln_f('actual', 'expected', P.alpha2, P.beta2)}, 6) AS ln_pmf2 FROM triple",
        ),
        "posterior_weight": scores("q", WEIGHT),
        "posterior_log_mean": _with(
            TRIPLES,
            f"SELECT {TRIPLE_COLUMNS}, round({_delta(D.alpha1, D.beta1)}, 6) AS delta1, "
            f"round({_delta(D.alpha2, D.beta2)}, 6) AS delta2 FROM triple",
        ),
        "ebgm_scores": scores("ebgm", EBGM),
        "ebgm_scores_mixed": scores("ebgm", EBGM_MIXED),
        "ebci_bounds": _recursive(
            f"{TRIPLES}, {QUANTILE}",
            f"SELECT {TRIPLE_COLUMNS}, round({EBCI['scale']}, 6) AS ebci FROM triple JOIN bound USING (actual)",
        ),
        "ebci_bounds_rate": _recursive(
            f"{TRIPLES}, {QUANTILE}",
            f"SELECT {TRIPLE_COLUMNS}, round({EBCI['rate']}, 6) AS ebci FROM triple JOIN bound USING (actual)",
        ),
        "ebci_bounds_mixed": _recursive(
            f"{TRIPLES}, {_bounds_of('ebci_scale', '({b} + expected)')}, {_bounds_of('ebci', '(1 / ({b} + expected))')}",
            f"SELECT {TRIPLE_COLUMNS}, round(ebci_scale, 6) AS ebci_scale, round(ebci, 6) AS ebci "
            "FROM triple JOIN ebci_scale_found USING (actual, expected) JOIN ebci_found USING (actual, expected)",
        ),
        "fit_step": _with(FITTED, _step()),
        "fit_mixture": _recursive(_fit([PLAIN_START]), f"SELECT {FIT_COLUMNS} FROM fitted"),
        "fit_starts": _recursive(_fit(random_starts()), f"SELECT {FIT_COLUMNS} FROM fitted"),
        "fit_mixture_multistart": _recursive(
            _fit(random_starts()), f"SELECT {FIT_COLUMNS} FROM fitted ORDER BY fitted.loglik DESC, start LIMIT 1"
        ),
        "read_report_lines": _with(SOURCES, " UNION ALL ".join(
            f"SELECT '{name}' AS source, count(*) AS n, CAST(sum(length(value)) AS BIGINT) AS chars, "
            f"min(value) AS first, max(value) AS last FROM {raw}" for name, (raw, _) in counted.items()
        )),
        "stage_table_parquet": _with(YEARLY, f"SELECT {TRIPLE_COLUMNS} FROM every_triple WHERE actual >= 3"),
        "stage_table_text": _with(YEARLY, f"SELECT {TRIPLE_COLUMNS} FROM every_triple WHERE actual >= 3"),
        "scored_signals_mixed": _recursive(
            f"{EXACT_TRIPLES}, {_bounds_of('ebci', '(1 / ({b} + expected))')}",
            f"SELECT {TRIPLE_COLUMNS}, round(actual / expected, 6) AS rrr, round({EBGM_MIXED}, 6) AS ebgm, "
            "round(ebci, 6) AS ebci FROM triple JOIN ebci_found USING (actual, expected) WHERE ebci >= 1",
        ),
        "rrr": scores("rrr", "actual / expected"),
        "scored_signals": _recursive(_scored("scale", 2.0), "SELECT * FROM signal"),
        "scored_signals_rate": _recursive(_scored("rate", 2.0), "SELECT * FROM signal"),
        "fit_input": _with(SQUASHED, "SELECT n, w, round(e, 6) AS e FROM cell"),
        "truncated_pmf": _with(
            FITTED,
            "SELECT n, w, round(e, 6) AS e, round(ln1, 6) AS ln_fstar1, round(ln2, 6) AS ln_fstar2 FROM parts",
        ),
        "mixture_loglik": _with(FITTED, "SELECT round(sum(w * ln(x1 + x2)), 3) AS loglik FROM mixed"),
        "mixture_responsibilities": _with(
            FITTED, "SELECT n, w, round(e, 6) AS e, round(x1 / (x1 + x2), 6) AS r FROM mixed"
        ),
        "mixture_gradient": _with(
            FITTED,
            "SELECT round(sum(w * x1 / (x1 + x2) * da1), 3) AS d_alpha1, "
            "round(sum(w * x1 / (x1 + x2) * db1), 3) AS d_beta1, "
            "round(sum(w * x2 / (x1 + x2) * da2), 3) AS d_alpha2, "
            "round(sum(w * x2 / (x1 + x2) * db2), 3) AS d_beta2 FROM mixed",
        ),
        "combination_filter": _recursive(NETWORK, "SELECT * FROM kept"),
        "signal_nodes": _recursive(NETWORK, "SELECT * FROM node"),
        "signal_edges": _recursive(
            NETWORK,
            "SELECT s.id AS source, t.id AS target, max(ebci) AS weight, "
            "string_agg(react, '$' ORDER BY ebgm DESC, react) AS reactions "
            "FROM kept JOIN node s ON s.label = drug1 JOIN node t ON t.label = drug2 GROUP BY ALL",
        ),
    }
