"""The expected result of every query, as SQL over the given tables."""

from __future__ import annotations

from checks.fixtures import CONCEPTS, SAMPLE_SIZE, SEED, VIEWS, needed_views

CONTIGS = ", ".join(f"'chr{c}'" for c in [*range(1, 23), "X", "Y", "M"])
CONCEPT_LIST = ", ".join(map(str, CONCEPTS))


def r6(expression: str, name: str | None = None, digits: int = 6) -> str:
    """Rounded to six digits, without negative zero."""
    return f"round({expression}, {digits}) + 0.0 as {name or expression}"


# Steps shared by several expectations, in order of dependence.
STEPS = {
    **VIEWS,
    "cases": f"""
        select distinct cast(person_id as varchar) as s from condition_occurrence
        where condition_concept_id in ({CONCEPT_LIST})""",
    "eligible": """
        select cast(person_id as varchar) as s from person
        where person_id in (select person_id from cb_search_person
                            where has_ehr_data = 1 and has_whole_genome_variant = 1)""",
    "cohort": """
        select s from eligible
        where not exists (select 1 from flagged_samples f where cast(f.sample_id as varchar) = eligible.s)""",
    "labelled": """
        select c.s, cast(case when k.s is null then 0 else 1 end as bigint) as phenotype_status
        from cohort c left join cases k on k.s = c.s""",
    "sampled": f"""
        select s, phenotype_status from (
          select *, row_number() over (partition by phenotype_status order by md5('{SEED}:'||s), s) as rn
          from labelled)
        where rn <= {SAMPLE_SIZE}""",
    "typed_weights": """
        select prs_id, case when hm_chr like 'chr%' then hm_chr else 'chr'||hm_chr end as contig,
          cast(try_cast(hm_pos as double) as int) as position,
          case when trim(effect_allele) = '' then null else effect_allele end as effect_allele,
          try_cast(effect_weight as double) as weight
        from raw_weights""",
    "clean_rows": f"""
        select * from typed_weights
        where position is not null and effect_allele is not null and weight is not null and contig in ({CONTIGS})""",
    "clean_weights": """
        select prs_id, contig, position, effect_allele, weight from (
          select *, row_number() over (partition by prs_id, contig, position order by weight, effect_allele) as rn
          from clean_rows)
        where rn = 1""",
    "loci": """
        select w.prs_id, v.variant_id, w.weight, w.effect_allele, v.ref, v.alt
        from clean_weights w join variants v on v.contig = w.contig and v.position = w.position""",
    "contributions": """
        select prs_id, s, variant_id, dosage, dosage * weight as contribution from (
          select l.prs_id, c.s, l.variant_id, l.weight,
            case when c.a1 is null then null
                 when c.a1 = 0 and c.a2 = 0 then case when l.effect_allele = l.ref then 2 else 0 end
                 when c.a1 <> c.a2 then case when l.effect_allele in (l.ref, l.alt) then 1 else 0 end
                 when c.a1 = 1 and c.a2 = 1 then case when l.effect_allele = l.alt then 2 else 0 end
                 else 0 end as dosage
          from calls c join loci l on l.variant_id = c.variant_id)""",
    "scored_models": "select distinct prs_id from loci",
    "scores": """
        select m.prs_id, c.s, coalesce(t.total, 0.0) as total_score, coalesce(t.n, 0) as variant_count,
          t.total / nullif(t.n, 0) as normalized_score
        from cohort c cross join scored_models m
        left join (select prs_id, s, sum(contribution) as total, count(contribution) as n
                   from contributions group by prs_id, s) t
          on t.prs_id = m.prs_id and t.s = c.s""",
    "people": """
        select sc.prs_id, sc.s, sc.total_score as score, l.phenotype_status as status,
          sc.variant_count, sc.normalized_score
        from scores sc join labelled l on l.s = sc.s""",
    "profile": """
        select prs_id, score, count(*) as n, sum(status) as n_cases from people group by prs_id, score""",
    "stats": """
        select prs_id, count(*) as n, sum(status) as n_cases, avg(score) as mean, stddev_samp(score) as std,
          min(score) as lo, max(score) as hi, count(distinct score) as n_distinct,
          quantile_cont(score, [0.0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5,
                                0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0]) as q
        from people group by prs_id""",
    "models_stats": """
        select *, (std is null or std = 0 or n_distinct < 10) as degenerate,
          (std is not null and std <> 0 and n_distinct >= 10
            and len(list_distinct([q[1],q[5],q[9],q[13],q[17],q[21]])) = 6
            and len(list_distinct([q[1],q[3],q[5],q[7],q[9],q[11],q[13],q[15],q[17],q[19],q[21]])) = 11) as has_quantiles
        from stats""",
    "ranked": """
        select p.prs_id, p.s, p.score, p.status, p.variant_count, p.normalized_score,
          m.n, m.mean, m.std, m.has_quantiles, m.degenerate,
          (p.score - m.mean) / m.std as z,
          (rank() over (partition by p.prs_id order by p.score)
            + (count(*) over (partition by p.prs_id, p.score) - 1) / 2.0) / m.n * 100 as pct,
          case when score<=q[5] then 1 when score<=q[9] then 2 when score<=q[13] then 3
               when score<=q[17] then 4 else 5 end as quintile,
          case when score<=q[3] then 1 when score<=q[5] then 2 when score<=q[7] then 3 when score<=q[9] then 4
               when score<=q[11] then 5 when score<=q[13] then 6 when score<=q[15] then 7 when score<=q[17] then 8
               when score<=q[19] then 9 else 10 end as decile
        from people p join models_stats m on m.prs_id = p.prs_id""",
    "standardised": """
        select *, case when has_quantiles then 'Q'||quintile else 'NA' end as risk_category,
          case when has_quantiles then 'D'||decile else 'NA' end as prs_decile
        from ranked""",
    "tails": """
        select p.prs_id, any_value((m.q[2]-m.mean)/m.std) as z_p5, any_value((m.q[20]-m.mean)/m.std) as z_p95,
          count(*) filter (score <= m.q[2]) as bottom_n,
          cast(coalesce(sum(status) filter (score <= m.q[2]), 0) as bigint) as bottom_cases,
          count(*) filter (score >= m.q[20]) as top_n,
          cast(coalesce(sum(status) filter (score >= m.q[20]), 0) as bigint) as top_cases
        from people p join models_stats m on m.prs_id = p.prs_id
        where not m.degenerate and m.n >= 40 and m.q[20] > m.q[2] and m.n_cases > 0 and m.n_cases < m.n
        group by p.prs_id""",
    "table2x2": """
        select prs_id, top_cases as a, top_n - top_cases as b, bottom_cases as c, bottom_n - bottom_cases as d
        from tails""",
    "log_p": """
        select prs_id, a, x,
          lgamma(k+1) - lgamma(x+1) - lgamma(k-x+1)
          + lgamma(t-k+1) - lgamma(r-x+1) - lgamma(t-k-r+x+1)
          - (lgamma(t+1) - lgamma(r+1) - lgamma(t-r+1)) as lp
        from (select prs_id, a, a+b as r, a+c as k, a+b+c+d as t,
                unnest(range(greatest(0, a+b+a+c-(a+b+c+d)), least(a+b, a+c) + 1)) as x
              from table2x2)""",
    "fisher": """
        select prs_id, least(1.0, sum(exp(lp)) filter (lp <= seen + 1e-7)) as p_value
        from (select l.*, (select o.lp from log_p o where o.prs_id = l.prs_id and o.x = o.a) as seen from log_p l)
        group by prs_id""",
    "tail_or": """
        select prs_id, case when a*b*c*d = 0 then ((a+0.5)*(d+0.5))/((b+0.5)*(c+0.5))
                            else (a*d)/cast(b*c as double) end as odds_ratio
        from table2x2""",
    "auc": """
        select r.prs_id, case when any_value(n_cases) in (0, any_value(n)) then null else
          (sum(pct / 100 * n) filter (status = 1) - any_value(n_cases) * (any_value(n_cases) + 1) / 2.0)
          / (any_value(n_cases) * (any_value(n) - any_value(n_cases))) end as auc
        from (select r.*, m.n_cases from ranked r join models_stats m on m.prs_id = r.prs_id) r
        group by r.prs_id""",
    "marks": """
        select k.phecode, k.person_id, sum(k.n) as n
        from phecode_counts k join phewas_cohort c on c.person_id = k.person_id
        where k.n > 0 group by k.phecode, k.person_id""",
    "phecode_cases": """
        select phecode, count(*) filter (n >= 2) as n_cases,
          (select count(*) from phewas_cohort) - count(*) as n_controls, count(*) filter (n < 2) as n_excluded
        from marks group by phecode having count(*) filter (n >= 2) >= 20""",
    "scan_rows": """
        select t.phecode, case when m.n >= 2 then 1 else 0 end as y, 1.0 as x0, cast(c.sv_status as double) as x1,
          c.pc1 as x2, cast(c.age_at_last_event as double) as x3, cast(c.sex_code as double) as x4, 0 as one_sex
        from phecode_cases t cross join phewas_cohort c
        left join marks m on m.phecode = t.phecode and m.person_id = c.person_id
        where m.n is null or m.n >= 2""",
}

# --- Newton's method, unrolled: one step per model for the odds ratio per SD. ---
OR_STEPS = 10


def _or_steps() -> dict[str, str]:
    steps = {
        "fit_rows": """
            select r.prs_id, r.z, r.status as y, case when r.status = 1 then m.n / (2.0 * m.n_cases)
              else m.n / (2.0 * (m.n - m.n_cases)) end as w
            from ranked r join models_stats m on m.prs_id = r.prs_id""",
        "fit0": "select prs_id, cast(0 as double) as b0, cast(0 as double) as b1 from models_stats",
    }
    for i in range(1, OR_STEPS + 1):
        steps[f"fit{i}"] = f"""
            select prs_id, b0 + (h11*g0 - h01*g1) / (h00*h11 - h01*h01) as b0,
              b1 + (h00*g1 - h01*g0) / (h00*h11 - h01*h01) as b1
            from (select prs_id, any_value(b0) as b0, any_value(b1) as b1,
                    sum(w*(y-p)) - any_value(b0) as g0, sum(w*(y-p)*z) - any_value(b1) as g1,
                    sum(w*p*(1-p)) + 1 as h00, sum(w*p*(1-p)*z) as h01, sum(w*p*(1-p)*z*z) + 1 as h11
                  from (select d.*, b.b0, b.b1, 1 / (1 + exp(-(b.b0 + b.b1*d.z))) as p
                        from fit_rows d join fit{i - 1} b on b.prs_id = d.prs_id)
                  group by prs_id)"""
    return steps


# --- Newton's method, unrolled: one step per phecode for the association scan. ---
SCAN_STEPS = 9
WIDTH = 5


def _scan_steps(at: str = "") -> dict[str, str]:
    """Each step sums a 5 x 5 system per phecode and eliminates it column by column.

    Column 5 of the system is the gradient, column 6 the unit vector of the exposure. Among people of one sex x4 is 0
    and its diagonal 1, so its coefficient stays 0. ``at`` begins the names of the steps and of their tables.
    """
    k = range(WIDTH)
    steps = {f"{at}scan0": "select phecode, " + ", ".join(f"cast(0 as double) as b{i}" for i in k) + f" from {at}phecode_cases"}
    for step in range(1, SCAN_STEPS + 1):
        eta = " + ".join(f"b.b{i}*d.x{i}" for i in k)
        last = WIDTH - 1
        sums = ", ".join(
            f"sum(p*(1-p)*x{min(i, j)}*x{max(i, j)}){' + max(one_sex)' if i == j == last else ''} as m{i}{j}" for i in k for j in k
        )
        gradient = ", ".join(f"sum((y-p)*x{i}) as m{i}5" for i in k)
        unit = ", ".join(f"cast({int(i == 1)} as double) as m{i}6" for i in k)
        keep = ", ".join(f"any_value(b{i}) as b{i}" for i in k)
        steps[f"{at}sys{step}_0"] = f"""
            select phecode, {keep}, {sums}, {gradient}, {unit}
            from (select d.*, {", ".join(f"b.b{i}" for i in k)}, 1 / (1 + exp(-({eta}))) as p
                  from {at}scan_rows d join {at}scan{step - 1} b on b.phecode = d.phecode)
            group by phecode"""
        for pivot in range(WIDTH - 1):
            cells = []
            for i in k:
                for j in range(WIDTH + 2):
                    if i > pivot:
                        cells.append(f"m{i}{j} - m{i}{pivot}/m{pivot}{pivot}*m{pivot}{j} as m{i}{j}")
                    else:
                        cells.append(f"m{i}{j}")
            steps[f"{at}sys{step}_{pivot + 1}"] = (
                f"select phecode, {', '.join(f'b{i}' for i in k)}, {', '.join(cells)} from {at}sys{step}_{pivot}"
            )
        solved = []
        for i in reversed(k):
            for rhs, name in ((5, "d"), (6, "v")):
                known = "".join(f" - m{i}{j}*{name}{j}" for j in range(i + 1, WIDTH))
                solved.append(f"(m{i}{rhs}{known}) / m{i}{i} as {name}{i}")
        steps[f"{at}scan{step}"] = f"""
            select phecode, {", ".join(f"b{i} + d{i} as b{i}" for i in k)}, v1
            from (select *, {", ".join(solved)} from {at}sys{step}_{WIDTH - 1})"""
    steps[f"{at}scan_fit"] = f"""
        select phecode, b1 as beta, sqrt(v1) as std_err, abs(b1 / sqrt(v1)) as z from {at}scan{SCAN_STEPS}"""
    # Two-sided normal p by Simpson's rule on [0, z] with 400 intervals.
    steps[f"{at}scan_p"] = f"""
        select phecode, beta, std_err, 1 - 2 * z / 1200 / sqrt(2 * pi()) * list_sum(list_transform(range(0, 401),
          lambda i: (case when i in (0, 400) then 1 when i % 2 = 1 then 4 else 2 end)
                    * exp(-0.5 * (z * i / 400.0) * (z * i / 400.0)))) as p_value
        from {at}scan_fit"""
    return steps


def _ruled_tables(at: str, male: int, use_exclusions: bool) -> dict[str, str]:
    """Marks, cases and rows of the scan where phecodes have their own risk sets; men are those with sex code ``male``."""
    related = """
        union all
        select r.target as phecode, k.person_id, false as is_case
        from numbered_counts k join (
          select d.phecode as target, c.phecode from phecode_definitions d
          join (select distinct phecode from numbered_counts) c
            on cast(c.phecode as double) between cast(d.exclude_first as double) and cast(d.exclude_last as double)) r
          on r.phecode = k.phecode"""
    fits = f"(d.sex = 'Both' or (d.sex = 'Male') = (c.sex_code = {male}))"
    return {
        f"{at}marks": f"""
            select m.phecode, m.person_id, bool_or(m.is_case) as is_case
            from (select phecode, person_id, sum(n) >= 2 as is_case from numbered_counts group by phecode, person_id
                  {related if use_exclusions else ''}) m
            join phewas_cohort c on c.person_id = m.person_id
            join phecode_definitions d on d.phecode = m.phecode
            where {fits} group by m.phecode, m.person_id""",
        f"{at}phecode_cases": f"""
            select m.phecode, count(*) filter (is_case) as n_cases,
              (select count(*) from phewas_cohort c where {fits}) - count(*) as n_controls
            from {at}marks m join phecode_definitions d on d.phecode = m.phecode
            group by m.phecode, d.sex having count(*) filter (is_case) >= 20""",
        f"{at}scan_rows": f"""
            select t.phecode, case when m.is_case then 1 else 0 end as y, 1.0 as x0, cast(c.sv_status as double) as x1,
              c.pc1 as x2, cast(c.age_at_last_event as double) as x3,
              case when d.sex = 'Both' then cast(c.sex_code as double) else 0.0 end as x4,
              case when d.sex = 'Both' then 0 else 1 end as one_sex
            from {at}phecode_cases t join phecode_definitions d on d.phecode = t.phecode
            join phewas_cohort c on {fits}
            left join {at}marks m on m.phecode = t.phecode and m.person_id = c.person_id
            where m.is_case is null or m.is_case""",
    }


STEPS.update(_or_steps())
STEPS.update(_scan_steps())
for _at, _male, _exclusions in (("sexed_", 0, False), ("ruled_", 1, True)):
    STEPS.update(_ruled_tables(_at, _male, _exclusions) | _scan_steps(_at))


def with_steps(sql: str) -> str:
    used = needed_views(sql, STEPS)
    if not used:
        return sql
    return "with " + ",\n".join(f"{name} as materialized ({STEPS[name]})" for name in used) + "\n" + sql


SCORE_COLUMNS = f"prs_id, s, {r6('total_score')}, cast(variant_count as bigint) as variant_count, normalized_score"
EXPORT_COLUMNS = (
    f"prs_id, s as person_id, {r6('total_score', 'prs_total_score')}, "
    f"cast(variant_count as bigint) as prs_variant_count, normalized_score as prs_normalized_score"
)
SUMMARY = f"""
    select m.prs_id, m.n as n_analysed, {r6('a.auc', 'auc')}, {r6('exp(f.b1)', 'or_per_sd')},
      {r6('o.odds_ratio', 'or_top_bottom')}, {r6('p.p_value', 'p_top_bottom')}
    from models_stats m left join auc a on a.prs_id = m.prs_id left join fit{OR_STEPS} f on f.prs_id = m.prs_id
    left join tail_or o on o.prs_id = m.prs_id left join fisher p on p.prs_id = m.prs_id"""
STATUS = """
    select ids.id as prs_id, coalesce(w.n, 0) as n_weights, coalesce(l.n, 0) as n_loci,
      case when coalesce(w.n, 0) = 0 then 'no valid weights' when coalesce(l.n, 0) = 0 then 'no overlap'
           else 'scored' end as status
    from (select unnest(['PGSA', 'PGSB', 'PGSC', 'PGSX', 'PGSY']) as id) ids
    left join (select prs_id, count(*) as n from clean_weights group by prs_id
               union all select 'PGSY', count(*) from clean_weights where prs_id = 'PGSB') w on w.prs_id = ids.id
    left join (select prs_id, count(*) as n from loci group by prs_id) l on l.prs_id = ids.id"""


def scan_sql(at: str = "") -> str:
    return f"""
    select t.phecode, t.n_cases, t.n_controls, {r6('beta')}, {r6('std_err')}, {r6('exp(beta)', 'odds_ratio')},
      {r6('exp(beta - 1.959963984540054 * std_err)', 'ci_low')},
      {r6('exp(beta + 1.959963984540054 * std_err)', 'ci_high')},
      {r6('p_value')}, {r6('-log10(p_value)', 'neg_log10_p')}, true as converged
    from {at}scan_p p join {at}phecode_cases t on t.phecode = p.phecode"""


SPARSE_COHORT = """
        select p.s, p.phenotype_status, coalesce(c.n, 0) as n_calls, coalesce(b.n, 0) as n_blocks,
          coalesce(b.bases, 0) as n_bases
        from sampled p
        left join (select s, count(*) as n from calls group by s) c on c.s = p.s
        left join (select s, cast(sum(ceil((end_pos - start_pos + 1) / 10000.0)) as bigint) as n,
                     cast(sum(end_pos - start_pos + 1) as bigint) as bases from reference_blocks group by s) b
          on b.s = p.s"""
PERCENT = "case when {n} > 0 then 100.0 * {c} / {n} else 0 end"
INTERVALS = """
    select prs_id, contig, position - 40 as start_pos, position - 60 + (position % 5) * 40 as end_pos
    from clean_weights"""

IN_INTERVALS = f"""
        select variant_id, contig, position from variants v
        where exists (select 1 from ({INTERVALS}) i
                      where i.start_pos <= i.end_pos and i.contig = v.contig
                        and v.position between i.start_pos and i.end_pos)"""

ORACLES = {
    "cases_by_concept": "select s, cast(1 as bigint) as phenotype_status from cases",
    "eligible_persons": "select s from eligible",
    "exclude_flagged_from_tsv": "select s from cohort",
    "label_cohort": "select s, phenotype_status as Ischemic_Stroke_status from labelled",
    "status_frequency": "select phenotype_status, count(*) as n from labelled group by phenotype_status",
    "split_by_status": "select s, case when phenotype_status = 1 then 'case' else 'control' end as side from labelled",
    "stratified_sample": "select s, phenotype_status from sampled",
    "restrict_calls": "select c.s, c.variant_id, c.a1, c.a2 from calls c where c.s in (select s from sampled)",
    "restrict_to_id_list": "select c.s, c.variant_id, c.a1, c.a2 from calls c where c.s in (select s from cases)",
    "dataset_counts": """
        select (select count(*) from person) as n_samples, (select count(*) from variants) as n_variants,
          count(*) as n_calls, count(a1) as n_called, cast(sum(a1) as bigint) as sum_a1, cast(sum(a2) as bigint) as sum_a2
        from calls""",
    "base_cohort": """
        select (select count(*) from sampled) as n_samples, (select count(*) from variants) as n_variants,
          count(*) as n_calls, count(a1) as n_called, cast(sum(a1) as bigint) as sum_a1,
          cast(sum(a2) as bigint) as sum_a2, true as verified
        from calls where s in (select s from sampled)""",
    "cohort_rebuilt_for_new_exclusions": """
        select l.s, l.phenotype_status, (select count(*) from calls c where c.s = l.s) as n_calls from labelled l
        where not exists (select 1 from more_flagged_samples f where cast(f.sample_id as varchar) = l.s)""",
    "exclude_from_sparse": """
        select p.s, coalesce(c.n, 0) as n_calls, coalesce(b.n, 0) as n_blocks
        from (select cast(person_id as varchar) as s from person) p
        left join (select s, count(*) as n from calls group by s) c on c.s = p.s
        left join (select s, count(*) as n from reference_blocks group by s) b on b.s = p.s
        where p.s not in (select cast(sample_id as varchar) from flagged_samples)""",
    "split_reference_blocks": """
        select s, contig, start_pos, cast(least(start_pos + 9999, end_pos) as int) as end_pos
        from (select s, contig, end_pos, cast(unnest(range(start_pos, end_pos + 1, 10000)) as int) as start_pos
              from reference_blocks)""",
    "sparse_base_cohort": SPARSE_COHORT,
    "dense_then_sparse": SPARSE_COHORT,
    "clean_weights": f"select prs_id, contig, position, effect_allele, {r6('weight')} from clean_rows",
    "weight_cleaning_report": f"""
        select prs_id, count(*) as n_raw,
          count(*) filter (not ok) as n_incomplete, count(*) filter (ok and not known) as n_unknown_contig,
          count(*) filter (ok and known) as n_kept
        from (select prs_id, position is not null and effect_allele is not null and weight is not null as ok,
                contig in ({CONTIGS}) as known from typed_weights)
        group by prs_id""",
    "one_weight_per_locus": f"select prs_id, contig, position, effect_allele, {r6('weight')} from clean_weights",
    "scoring_files": f"select prs_id, contig, position, effect_allele, {r6('weight')} from clean_weights",
    "prepared_intervals": """
        select prs_id, contig, position as start_pos, position as end_pos from clean_weights""",
    "weight_table_roundtrip": f"select prs_id, contig, position, effect_allele, {r6('weight')} from clean_weights",
    "extract_intervals": """
        select distinct contig, position as start_pos, position as end_pos from clean_weights""",
    "point_semi_join": """
        select variant_id, contig, position from variants v
        where exists (select 1 from clean_weights w
                      where w.prs_id = 'PGSA' and w.contig = v.contig and w.position = v.position)""",
    "interval_semi_join": IN_INTERVALS,
    "interval_walk": IN_INTERVALS,
    "call_kinds": """
        select a1 is null as missing, coalesce(a1 = 0 and a2 = 0, false) as hom_ref,
          coalesce(a1 <> a2, false) as het, coalesce(a1 = a2 and a1 > 0, false) as hom_var,
          coalesce(a1 = 1 or a2 = 1, false) as has_alternate,
          case when a1 is null then null when a2 is null then 1 else 2 end as ploidy, count(*) as n
        from calls group by all""",
    "effect_allele_index": """
        select prs_id, variant_id, effect_allele = ref as effect_is_ref,
          case when effect_allele = alt then 1 else 0 end as alternate_index
        from loci""",
    "dosage_contributions": f"""
        select prs_id, s, variant_id, cast(dosage as int) as dosage, {r6('contribution')} from contributions""",
    "score_one_model": f"select {SCORE_COLUMNS} from scores where prs_id = 'PGSA'",
    "score_all_models": f"select {SCORE_COLUMNS} from scores",
    "score_shuffled_loci": f"select {SCORE_COLUMNS} from scores",
    "score_blocked": f"select {SCORE_COLUMNS} from scores",
    "score_pruned": f"""
        select m.prs_id, c.s, {r6('coalesce(t.total, 0.0)', 'total_score')}, cast(coalesce(t.n, 0) as bigint) as variant_count,
          t.total / nullif(t.n, 0) as normalized_score
        from cohort c cross join (select distinct prs_id from loci l join variants v on v.variant_id = l.variant_id
                                  where v.contig in ('chr2', 'chr5', 'chr11')) m
        left join (select b.prs_id, b.s, sum(b.contribution) as total, count(b.contribution) as n
                   from contributions b join variants v on v.variant_id = b.variant_id
                   where v.contig in ('chr2', 'chr5', 'chr11') group by b.prs_id, b.s) t
          on t.prs_id = m.prs_id and t.s = c.s""",
    "score_tiled": f"select {SCORE_COLUMNS} from scores",
    "calls_from_tiles": "select variant_id, s, a1, a2 from calls",
    "score_many_loci": f"select {SCORE_COLUMNS} from scores",
    "scoring_status": STATUS,
    "score_export": f"select {EXPORT_COLUMNS} from scores",
    "unusable_scores": """
        select prs_id, count(*) as n_joined, count(*) filter (variant_count % 5 < 3) as n_dropped
        from people group by prs_id""",
    "model_statistics": f"""
        select prs_id, n, cast(n_cases as bigint) as n_cases, {r6('mean')}, {r6('std')}, {r6('lo', 'min')}, {r6('hi', 'max')},
          n_distinct, degenerate, has_quantiles
        from models_stats""",
    "exact_quantiles": f"""
        select prs_id, cast(k as int) as k, {r6('q[k + 1]', 'value', 9)}
        from (select prs_id, q, unnest(range(0, 21)) as k from models_stats)""",
    "zscore_and_bins": f"select prs_id, s, {r6('z', 'prs_zscore')}, risk_category, prs_decile from standardised",
    "percentile_rank": f"select prs_id, s, {r6('pct', 'prs_percentile')} from standardised",
    "standardised_scores": f"""
        select prs_id, s as person_id, {r6('score', 'prs_total_score')},
          cast(variant_count as bigint) as prs_variant_count, normalized_score as prs_normalized_score,
          status as Ischemic_Stroke_status, {r6('z', 'prs_zscore')}, {r6('pct', 'prs_percentile')}, risk_category, prs_decile
        from standardised""",
    "hot_score_ranks": f"select prs_id, s, {r6('pct', 'prs_percentile')} from standardised",
    "degenerate_scores": """
        select prs_id, s, cast(0 as double) as prs_zscore, cast(50 as double) as prs_percentile, 'Average' as risk_category, 'D5' as prs_decile
        from people""",
    "degenerate_summary": """
        select prs_id, count(*) as n_analysed, cast(0.5 as double) as auc, cast(1 as double) as or_per_sd, cast(null as double) as or_top_bottom,
          cast(null as double) as p_top_bottom
        from people group by prs_id""",
    "describe_scores": f"""
        select prs_id, 'score' as measure, n, {r6('mean')}, {r6('std')}, {r6('lo', 'min')}, {r6('q[6]', 'p25')},
          {r6('q[11]', 'p50')}, {r6('q[16]', 'p75')}, {r6('hi', 'max')} from models_stats
        union all
        select prs_id, 'zscore', n, 0.0, 1.0, {r6('(lo-mean)/std', 'a')}, {r6('(q[6]-mean)/std', 'b')},
          {r6('(q[11]-mean)/std', 'c')}, {r6('(q[16]-mean)/std', 'd')}, {r6('(hi-mean)/std', 'e')} from models_stats""",
    "histogram": f"""
        select g.prs_id, cast(g.bin as int) as bin, {r6('g.zlo + g.bin * g.w', 'bin_start')},
          {r6('g.zlo + (g.bin + 1) * g.w', 'bin_end')}, coalesce(f.n, 0) as n_people
        from (select prs_id, (lo-mean)/std as zlo, (hi-lo)/std/50 as w, unnest(range(0, 50)) as bin from models_stats) g
        left join (select p.prs_id, least(floor((p.score - m.lo) * 50.0 / (m.hi - m.lo)), 49) as bin, count(*) as n
                   from people p join models_stats m on m.prs_id = p.prs_id group by 1, 2) f
          on f.prs_id = g.prs_id and f.bin = g.bin""",
    "kernel_density": f"""
        select g.prs_id, cast(g.point as int) as point, {r6('g.a + g.point * g.d', 'z')},
          {r6('''(select sum(p.n * exp(-0.5 * ((g.a + g.point * g.d - (p.score - g.mean) / g.std) / g.h)
                   * ((g.a + g.point * g.d - (p.score - g.mean) / g.std) / g.h)))
              from profile p where p.prs_id = g.prs_id) / (g.n * g.h * sqrt(2 * pi()))''', 'density')}
        from (select *, zlo - 3*h as a, (zhi - zlo + 6*h) / 199 as d, unnest(range(0, 200)) as point
              from (select prs_id, n, mean, std, (lo-mean)/std as zlo, (hi-mean)/std as zhi,
                      pow(n, -0.2) as h from models_stats where not degenerate)) g""",
    "decile_prevalence": f"""
        select g.prs_id, g.prs_decile, coalesce(f.n, 0) as n_people, cast(coalesce(f.c, 0) as bigint) as n_cases,
          {r6('coalesce(100.0 * f.c / f.n, 0)', 'prevalence_percent')}
        from (select prs_id, 'D'||unnest(range(1, 11)) as prs_decile from models_stats where has_quantiles) g
        left join (select prs_id, prs_decile, count(*) as n, sum(status) as c from standardised group by 1, 2) f
          on f.prs_id = g.prs_id and f.prs_decile = g.prs_decile""",
    "roc_curve": f"""
        select prs_id, {r6('(score - mean) / std', 'threshold')}, {r6('neg / (n - n_cases)', 'fpr')}, {r6('pos / n_cases', 'tpr')}
        from (select p.prs_id, p.score, m.mean, m.std, m.n, m.n_cases,
                sum(p.n_cases) over w as pos, sum(p.n - p.n_cases) over w as neg
              from profile p join models_stats m on m.prs_id = p.prs_id
              window w as (partition by p.prs_id order by p.score desc))
        union all select prs_id, null, 0.0, 0.0 from models_stats""",
    "roc_auc": f"select prs_id, {r6('auc')} from auc",
    "tail_thresholds": f"""
        select t.prs_id, {r6('m.q[2]', 'score_p5', 9)}, {r6('m.q[20]', 'score_p95', 9)}, {r6('z_p5')}, {r6('z_p95')}
        from tails t join models_stats m on m.prs_id = t.prs_id""",
    "tail_comparison": f"""
        select prs_id, {r6('z_p5')}, {r6('z_p95')}, bottom_n, bottom_cases,
          {r6(PERCENT.format(n='bottom_n', c='bottom_cases'), 'bottom_prevalence')}, top_n, top_cases,
          {r6(PERCENT.format(n='top_n', c='top_cases'), 'top_prevalence')}
        from tails""",
    "contingency": """
        select prs_id, a as high_cases, b as high_controls, c as low_cases, d as low_controls from table2x2""",
    "fisher_tails": f"""
        select o.prs_id, {r6('o.odds_ratio', 'odds_ratio')}, {r6('f.p_value', 'p_value')}
        from tail_or o join fisher f on f.prs_id = o.prs_id""",
    "odds_ratio_per_sd": f"select prs_id, {r6('exp(b1)', 'or_per_sd')}, true as converged from fit{OR_STEPS}",
    "model_summary": SUMMARY,
    "summary_text": f"""
        select prs_id, n_analysed, printf('%.4f', auc) as auc, printf('%.3f', or_per_sd) as or_per_sd,
          printf('%.2f', or_top_bottom) as or_top_bottom from ({SUMMARY})""",
    "evaluate_files": SUMMARY,
    "whole_study": f"""
        select st.prs_id, st.n_weights, st.n_loci, st.status, s.n_analysed
        from ({STATUS}) st left join (select prs_id, count(*) as n_analysed from scores
                                      where s in (select s from sampled) group by prs_id) s on s.prs_id = st.prs_id""",
    "study_from_manifest": f"""
        select ids.id as prs_id, coalesce(w.n, 0) as n_weights, coalesce(l.n, 0) as n_loci,
          case when ids.id in ('PGSX', 'PGSZ') then 'unreadable' else 'scored' end as status,
          s.n_analysed, s.auc, s.or_per_sd, s.or_top_bottom, s.p_top_bottom
        from (select unnest(['PGSA', 'PGSB', 'PGSC', 'PGSX', 'PGSZ']) as id) ids
        left join (select prs_id, count(*) as n from clean_weights group by prs_id) w on w.prs_id = ids.id
        left join (select prs_id, count(*) as n from loci group by prs_id) l on l.prs_id = ids.id
        left join ({SUMMARY}) s on s.prs_id = ids.id""",
    "checkpoint_reuse": "select prs_id, count(*) as n from clean_weights group by prs_id",
    "phecode_case_counts": "select phecode, n_cases, n_controls, n_excluded from phecode_cases",
    "association_scan": scan_sql(),
    "association_scan_by_sex": scan_sql("sexed_"),
    "association_scan_exclusions": scan_sql("ruled_"),
    "association_scan_files": scan_sql(),
    "bonferroni": f"""
        select count(*) as n_tested, {r6('-log10(0.05 / count(*))', 'threshold')},
          count(*) filter (-log10(p_value) > -log10(0.05 / (select count(*) from scan_p))) as n_above
        from scan_p""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_steps(sql) for name, sql in ORACLES.items()}
