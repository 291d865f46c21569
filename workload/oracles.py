"""DuckDB SQL that answers every registered query from the same Parquet tables.

``VIEWS`` are named steps; ``FINAL`` holds the closing SELECT of each query. ``sql()`` puts the
steps a query needs, and only those, in front of it.
"""

from __future__ import annotations

import re

# Industry codes and labels, spelled out here so that the check is independent.
DIMENSION = (
    (1, 'Defense & Space'), (3, 'Computer Hardware'), (4, 'Computer Software'),
    (5, 'Computer Networking'), (6, 'Internet'), (7, 'Computer & Network Security'),
    (8, 'Information Technology & Services'), (9, 'Semiconductors'), (10, 'Telecommunications'),
    (11, 'Law Practice'), (12, 'Legal Services'), (13, 'Management Consulting'),
    (14, 'Biotechnology'), (15, 'Medical Practice'), (16, 'Hospital & Health Care'),
    (17, 'Pharmaceuticals'), (18, 'Veterinary'), (19, 'Medical Devices'), (20, 'Cosmetics'),
    (21, 'Apparel & Fashion'), (22, 'Sporting Goods'), (23, 'Tobacco'), (24, 'Supermarkets'),
    (25, 'Food Production'), (26, 'Consumer Electronics'), (27, 'Consumer Goods'),
    (28, 'Furniture'), (29, 'Retail'), (30, 'Entertainment'), (31, 'Gambling & Casinos'),
    (32, 'Leisure, Travel & Tourism'), (33, 'Hospitality'), (34, 'Restaurants'), (35, 'Sports'),
    (36, 'Food & Beverages'), (37, 'Motion Pictures & Film'), (38, 'Broadcast Media'),
    (39, 'Museums & Institutions'), (40, 'Fine Art'), (41, 'Performing Arts'),
    (42, 'Recreational Facilities & Services'), (43, 'Banking'), (44, 'Insurance'),
    (45, 'Financial Services'), (46, 'Real Estate'), (47, 'Investment Banking'),
    (48, 'Investment Management'), (49, 'Accounting'), (50, 'Construction'),
    (51, 'Building Materials'), (52, 'Architecture & Planning'), (53, 'Civil Engineering'),
    (54, 'Aviation & Aerospace'), (55, 'Automotive'), (56, 'Chemicals'), (57, 'Machinery'),
    (58, 'Mining & Metals'), (59, 'Oil & Energy'), (60, 'Utilities'), (61, 'Shipbuilding'),
    (62, 'Packaging & Containers'), (63, 'Railroad Manufacture'),
    (64, 'Renewables & Environment'), (65, 'Glass, Ceramics & Concrete'), (66, 'Textiles'),
    (67, 'Warehousing'), (68, 'Airlines/Aviation'), (69, 'Maritime'),
    (70, 'Transportation/Trucking/Railroad'), (71, 'Logistics & Supply Chain'),
    (72, 'Import & Export'), (73, 'Primary/Secondary Education'), (74, 'Higher Education'),
    (75, 'Education Management'), (76, 'Research'), (77, 'Military'), (78, 'Legislative Office'),
    (79, 'Judiciary'), (80, 'International Affairs'), (81, 'Government Administration'),
    (82, 'Executive Office'), (83, 'Law Enforcement'), (84, 'Public Safety'),
    (85, 'Public Policy'), (86, 'Marketing & Advertising'), (87, 'Newspapers'),
    (88, 'Publishing'), (89, 'Printing'), (90, 'Information Services'), (91, 'Libraries'),
    (92, 'Environmental Services'), (93, 'Package/Freight Delivery'),
    (94, 'Individual & Family Services'), (95, 'Religious Institutions'),
    (96, 'Civic & Social Organization'), (97, 'Consumer Services'),
    (98, 'Nonprofit Organization Management'), (99, 'Fund-Raising'), (100, 'Program Development'),
    (101, 'Writing & Editing'), (102, 'Staffing & Recruiting'),
    (103, 'Professional Training & Coaching'), (104, 'Market Research'),
    (105, 'Public Relations & Communications'), (106, 'Design'), (107, 'Graphic Design'),
    (108, 'Photography'), (109, 'Arts & Crafts'), (110, 'Animation'), (111, 'Music'),
    (112, 'Online Media'), (113, 'Events Services'), (114, 'Business Supplies & Equipment'),
    (115, 'E-Learning'), (116, 'Outsourcing/Offshoring'), (117, 'Facilities Services'),
    (118, 'Human Resources'), (119, 'Venture Capital & Private Equity'), (120, 'Think Tanks'),
    (121, 'Nanotechnology'), (122, 'Computer Games'), (123, 'Alternative Medicine'),
    (124, 'Health, Wellness & Fitness'), (125, 'Alternative Dispute Resolution'),
    (126, 'Mental Health Care'), (127, 'Philanthropy'),
    (128, 'International Trade & Development'), (129, 'Wireless'), (130, 'Capital Markets'),
    (131, 'Political Organization'), (132, 'Translation & Localization'),
    (133, 'Computer & Network Security'), (134, 'Farming'), (135, 'Ranching'), (136, 'Dairy'),
    (137, 'Fishery'), (138, 'Paper & Forest Products'), (139, 'Forestry'),
    (140, 'Luxury Goods & Jewelry'), (141, 'Renewables & Environment'),
    (142, 'Mechanical or Industrial Engineering'), (143, 'Industrial Automation'),
    (144, 'Electrical/Electronic Manufacturing'), (145, 'Plastics'), (146, 'Rubber & Plastics'),
    (147, 'Wholesale'), (148, 'Commercial Real Estate'), (149, 'Banking'),
    (150, 'Leasing Real Estate'),
)

SPELLED_NULL = "CAST(NULL AS VARCHAR)"


def _pick(index: str, values: list[str]) -> str:
    return "CASE " + index + " " + " ".join(
        f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)
    ) + " END"


def _money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR)"


WORK = _pick(
    "l_partkey % 8",
    ["Full-time", "TEMPS PARTIEL", " contrat ", "stage", "Intérim", "apprentissage", " ", "Volunteer"],
)
FLAGS = ["1.0", "0", "Yes", "FAUX", "on", "", "maybe", "Oui", "f"]
SIX = ", ".join(f"arrival_{i}" for i in range(1, 7))

VIEWS = {
    "part_lines": "SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey",
    "b_postings": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS job_id,
               CASE WHEN l_linenumber = 7 THEN 'Supplier ' || l_suppkey
                    ELSE l_suppkey || '.0' END AS company_name,
               CASE WHEN l_linenumber = 6 THEN '  ' ELSE ' ' || p_name || ' ' END AS title,
               p_type AS description,
               CASE l_linenumber WHEN 5 THEN 'n/a' WHEN 4 THEN ''
                    ELSE {_money('l_extendedprice')} END AS max_salary,
               {SPELLED_NULL} AS med_salary,
               CAST(floor(l_extendedprice / 2) AS BIGINT) || '.75' AS min_salary,
               {_pick('l_partkey % 7', ['Per Year', ' par mois ', 'horaire', 'PER WEEK',
                                        'journalier', '', 'YEARLY'])} AS pay_period,
               {WORK} AS formatted_work_type,
               ' ' || p_brand AS location,
               CAST(l_linenumber AS VARCHAR) AS applies,
               CAST(epoch_ms(l_shipdate) AS VARCHAR) AS original_listed_time,
               {_pick('l_suppkey % 9', FLAGS)} AS remote_allowed,
               CASE WHEN l_linenumber = 2 THEN 'abc' ELSE CAST(l_partkey AS VARCHAR) END AS views,
               {SPELLED_NULL} AS job_posting_url,
               {SPELLED_NULL} AS application_url,
               {SPELLED_NULL} AS application_type,
               CAST(epoch_ms(l_shipdate) + 2592000000 AS VARCHAR) AS expiry,
               {SPELLED_NULL} AS closed_time,
               {_pick('l_suppkey % 8', ['stage', 'Junior', 'confirmé', 'EXPÉRIMENTÉ', 'Directeur',
                                        'cadre dirigeant', '', 'Other'])}
                   AS formatted_experience_level,
               {SPELLED_NULL} AS skills_desc,
               CASE WHEN l_linenumber = 3 AND l_partkey % 5 = 0 THEN NULL
                    WHEN l_linestatus = 'F' THEN CAST(epoch_ms(l_shipdate) AS VARCHAR)
                    ELSE CAST(epoch_ms(l_shipdate) // 1000 AS VARCHAR) END AS listed_time,
               {SPELLED_NULL} AS posting_domain,
               {_pick('l_partkey % 9', FLAGS)} AS sponsored,
               {WORK} AS work_type,
               'USD' AS currency,
               'BASE' AS compensation_type,
               l_linenumber AS arrival_1, l_partkey AS arrival_2, l_suppkey AS arrival_3,
               l_shipdate AS arrival_4, l_extendedprice AS arrival_5, l_linestatus AS arrival_6
        FROM part_lines""",
    "b_benefits": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS job_id,
               {_pick('l_linenumber - 1', ['1', 'vrai', 'NO', '1.0', '', ' oui ', 'faux'])}
                   AS inferred,
               CASE WHEN l_linenumber % 2 = 1 THEN upper(' ' || p_type)
                    ELSE lower(' ' || p_type) END AS type,
               l_linenumber AS arrival_1, l_partkey AS arrival_2
        FROM part_lines""",
    "b_counts": f"""
        SELECT CAST(user_id + 5 AS VARCHAR) AS company_id,
               {_money('value')} AS employee_count,
               regexp_extract(props, '[0-9]+') AS follower_count,
               CASE WHEN event_id % 11 = 0 THEN NULL
                    WHEN event_id % 2 = 0 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
                    ELSE CAST(epoch_us(ts) // 1000000 AS VARCHAR) END AS time_recorded,
               event_id AS arrival_1
        FROM events""",
    "b_skills": """
        SELECT CAST(l_orderkey AS VARCHAR) AS job_id,
               CASE WHEN l_linenumber = 7 THEN ' '
                    WHEN l_linenumber % 2 = 0 THEN lower(p_brand) || ' '
                    ELSE p_brand END AS skill_abr
        FROM part_lines""",
    "b_companies": f"""
        SELECT s_suppkey AS company_id, ' ' || s_name || ' ' AS name,
               s_nationkey % 7 + 1 AS company_size, n_name AS country,
               {', '.join(f'{SPELLED_NULL} AS {c}' for c in
                          ('description', 'state', 'city', 'zip_code', 'address', 'url'))}
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "b_industries": "SELECT l_orderkey AS job_id, l_partkey % 155 AS industry_id FROM lineitem",
    "b_industries_gaps": """
        SELECT l_orderkey AS job_id,
               CASE WHEN l_linestatus <> 'O' THEN l_partkey % 155 END AS industry_id
        FROM lineitem""",
    "b_company_industries": """
        SELECT l_suppkey AS company_id,
               CASE WHEN l_linenumber % 2 = 1 THEN ' ' || upper(p_type) || ' '
                    ELSE p_type END AS industry
        FROM part_lines""",
    "b_company_specialities": """
        SELECT l_suppkey AS company_id,
               CASE WHEN l_linenumber = 7 THEN '' ELSE p_brand END AS speciality
        FROM part_lines""",
}


def text(c: str) -> str:
    return f"NULLIF(TRIM({c}), '')"


def number(c: str) -> str:
    return f"CAST(TRY_CAST({c} AS DECIMAL(38,0)) AS BIGINT)"


def instant(c: str) -> str:
    n = number(c)
    return (
        f"CASE WHEN {n} > 100000000000 THEN make_timestamp_ms({n}) "
        f"ELSE make_timestamp_ms({n} * 1000) END"
    )


def flag(c: str) -> str:
    return (
        f"CASE WHEN lower({c}) IN ('true','t','yes','y','on','1','vrai','oui') THEN TRUE "
        f"WHEN lower({c}) IN ('false','f','no','n','off','0','faux','non') THEN FALSE "
        f"WHEN TRY_CAST({c} AS DECIMAL(38,0)) = 1 THEN TRUE "
        f"WHEN TRY_CAST({c} AS DECIMAL(38,0)) = 0 THEN FALSE END"
    )


def listed_flag(c: str) -> str:
    return (
        f"CASE WHEN lower(trim({c})) IN ('true','1','yes','vrai','oui') THEN TRUE "
        f"WHEN lower(trim({c})) IN ('false','0','no','faux','non') THEN FALSE END"
    )


def _words(c: str, pairs: list[tuple[str, str]]) -> str:
    arms = " ".join(f"WHEN lower(trim({c})) IN ({words}) THEN '{label}'" for label, words in pairs)
    return f"CASE {arms} ELSE {text(c)} END"


# Fixed values below: vocabularies, colours and sentences that results must contain.
def pay_period(c: str) -> str:
    return _words(c, [
        ("yearly", "'per year','par an','annuel'"),
        ("monthly", "'per month','par mois','mensuel'"),
        ("weekly", "'per week','par semaine','hebdomadaire'"),
        ("daily", "'per day','par jour','journalier'"),
        ("hourly", "'per hour','par heure','horaire'"),
    ])


FIVE_TYPES = [
    ("Full-time", "'full-time','temps plein'"),
    ("Part-time", "'part-time','temps partiel'"),
    ("Contract", "'contract','contrat'"),
    ("Internship", "'internship','stage'"),
    ("Temporary", "'temporary','intérim','temporaire'"),
]
SIX_TYPES = [*FIVE_TYPES, ("Apprenticeship", "'apprenticeship','apprentissage'")]


def level(c: str) -> str:
    return _words(c, [
        ("Internship", "'internship','stage'"),
        ("Entry level", "'entry level','débutant','junior'"),
        ("Associate", "'associate','confirmé'"),
        ("Mid-Senior level", "'mid-senior level','expérimenté'"),
        ("Director", "'director','directeur'"),
        ("Executive", "'executive','cadre dirigeant'"),
    ])


def _latest(source: str, key: str, recency: str, ties: str, nulls: str = "FIRST") -> str:
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {recency} DESC NULLS {nulls}, {ties}) = 1"
    )


VIEWS |= {
    "kept_postings": _latest("b_postings", "job_id", instant("listed_time"), SIX),
    "kept_postings_last": _latest("b_postings", "job_id", instant("listed_time"), SIX, "LAST"),
    "kept_counts": _latest(
        "b_counts", number("company_id"), number("time_recorded"), "arrival_1"
    ),
    "s_postings": f"""
        SELECT CAST(job_id AS BIGINT) AS job_id, {text('company_name')} AS company_name,
               {text('title')} AS title, description,
               {number(text('max_salary'))} AS max_salary,
               {number(text('med_salary'))} AS med_salary,
               {number(text('min_salary'))} AS min_salary,
               {pay_period('pay_period')} AS pay_period,
               {_words('formatted_work_type', SIX_TYPES)} AS formatted_work_type,
               {text('location')} AS location, {number(text('applies'))} AS applies,
               {instant('original_listed_time')} AS original_listed_time,
               {flag('remote_allowed')} AS remote_allowed, {number(text('views'))} AS views,
               job_posting_url, application_url, application_type,
               {instant('expiry')} AS expiry, {instant('closed_time')} AS closed_time,
               {level('formatted_experience_level')} AS formatted_experience_level,
               skills_desc, {instant('listed_time')} AS listed_time, posting_domain,
               {flag('sponsored')} AS sponsored, {_words('work_type', FIVE_TYPES)} AS work_type,
               currency, compensation_type
        FROM kept_postings""",
    "s_benefits": f"""
        SELECT CAST(job_id AS BIGINT) AS job_id, {listed_flag('inferred')} AS inferred,
               {text('type')} AS type
        FROM b_benefits
        QUALIFY row_number() OVER (PARTITION BY b_benefits.job_id, lower(trim(b_benefits.type))
                                   ORDER BY arrival_1, arrival_2) = 1""",
    "s_companies": f"""
        SELECT company_id, {text('name')} AS name, description,
               CAST(company_size AS BIGINT) AS company_size, state, {text('country')} AS country,
               city, zip_code, address, url
        FROM b_companies""",
    "s_counts": f"""
        SELECT {number('company_id')} AS company_id,
               {number(text('employee_count'))} AS employee_count,
               {number(text('follower_count'))} AS follower_count,
               {instant('time_recorded')} AS time_recorded
        FROM kept_counts""",
    "s_skills": f"""
        SELECT DISTINCT {number('job_id')} AS job_id, NULLIF(upper(trim(skill_abr)), '') AS skill_abr
        FROM b_skills""",
    "s_industries": "SELECT DISTINCT job_id, industry_id FROM b_industries",
    "s_industries_gaps": "SELECT DISTINCT job_id, industry_id FROM b_industries_gaps",
    "s_company_industries": """
        SELECT DISTINCT company_id, NULLIF(lower(trim(industry)), '') AS industry
        FROM b_company_industries""",
    "s_company_specialities": """
        SELECT DISTINCT company_id, NULLIF(lower(trim(speciality)), '') AS speciality
        FROM b_company_specialities""",
    "g_postings": "SELECT * FROM s_postings WHERE job_id IS NOT NULL",
    "g_industries": """
        SELECT * FROM s_industries WHERE job_id IS NOT NULL AND industry_id IS NOT NULL""",
    "g_industries_gaps": """
        SELECT * FROM s_industries_gaps WHERE job_id IS NOT NULL AND industry_id IS NOT NULL""",
    "g_skills": "SELECT * FROM s_skills WHERE job_id IS NOT NULL AND skill_abr IS NOT NULL",
    "g_profile": """
        SELECT c.company_id, name, company_size, city, state, country, employee_count,
               follower_count
        FROM s_companies c LEFT JOIN s_counts e ON c.company_id = e.company_id
        WHERE c.company_id IS NOT NULL""",
}


def _analytics(industries: str) -> str:
    return f"""
        SELECT j.job_id, j.title, c.name AS company_name, j.formatted_work_type, j.work_type,
               j.remote_allowed, j.formatted_experience_level, j.min_salary, j.med_salary,
               j.max_salary, j.currency, i.industry_id, c.company_size, c.country, j.listed_time
        FROM g_postings j
        LEFT JOIN {industries} i ON j.job_id = i.job_id
        LEFT JOIN g_profile c ON TRY_CAST(j.company_name AS DECIMAL(38,0)) = c.company_id"""


VIEWS |= {
    "analytics": _analytics("g_industries"),
    "analytics_gaps": _analytics("g_industries_gaps"),
    "dimension": "SELECT * FROM (VALUES "
    + ", ".join(f"({code}, '{label}')" for code, label in DIMENSION)
    + ") AS d(code, label)",
    "title_counts": """
        SELECT industry_id, title, count(*) AS n FROM analytics
        WHERE industry_id IS NOT NULL AND title IS NOT NULL GROUP BY ALL""",
    "title_ranks": """
        SELECT * FROM title_counts
        QUALIFY row_number() OVER (PARTITION BY industry_id ORDER BY n DESC, title) <= 10""",
    "title_means": """
        SELECT industry_id, title, round(avg(max_salary), 0) AS mean FROM analytics
        WHERE industry_id IS NOT NULL AND max_salary IS NOT NULL GROUP BY ALL""",
    "title_mean_ranks": """
        SELECT * FROM title_means
        QUALIFY row_number() OVER (PARTITION BY industry_id
                                   ORDER BY mean DESC, title NULLS FIRST) <= 10""",
    "labelled_titles": """
        SELECT t.*, coalesce(label, 'Other') AS industry_name
        FROM title_ranks t LEFT JOIN dimension ON industry_id = code""",
    "labelled_means": """
        SELECT t.*, coalesce(label, 'Other') AS industry_name
        FROM title_mean_ranks t LEFT JOIN dimension ON industry_id = code""",
    "industry_counts": """
        SELECT industry_id, count(*) AS n FROM analytics
        WHERE industry_id IS NOT NULL GROUP BY industry_id""",
    "top10": """
        SELECT industry_id, n AS nb_jobs, coalesce(label, 'Other') AS industry_name
        FROM (SELECT * FROM industry_counts ORDER BY n DESC, industry_id LIMIT 10)
        LEFT JOIN dimension ON industry_id = code""",
    "shares": """
        SELECT *, CAST(nb_jobs AS DOUBLE) / CAST(sum(nb_jobs) OVER () AS DOUBLE) AS pct
        FROM top10""",
    "contract_counts": """
        SELECT formatted_work_type, count(*) AS n FROM analytics
        WHERE formatted_work_type IS NOT NULL GROUP BY formatted_work_type""",
}

ALL_POSTING = (
    "job_id, company_name, title, description, max_salary, med_salary, min_salary, pay_period, "
    "formatted_work_type, location, applies, original_listed_time, remote_allowed, views, "
    "job_posting_url, application_url, application_type, expiry, closed_time, "
    "formatted_experience_level, skills_desc, listed_time, posting_domain, sponsored, work_type, "
    "currency, compensation_type"
)
KEPT = "SELECT job_id, listed_time, title, views FROM "
BLOCKS = "CAST(trunc(pct * 100) AS BIGINT)"


def _panel(source: str, measure: str, alias: str, industry: str, nulls: str = "") -> str:
    return f"""
        SELECT industry_id, title, {measure} AS {alias}, industry_name FROM {source}
        WHERE industry_name = '{industry}'
        ORDER BY {measure} DESC, title {nulls}, industry_id LIMIT 10"""


FINAL = {
    "clean_text": f"""SELECT job_id, {text('company_name')} AS company_name,
        {text('title')} AS title, {text('location')} AS location FROM b_postings""",
    "clean_label": """SELECT job_id, NULLIF(upper(trim(skill_abr)), '') AS upper_skill,
        NULLIF(lower(trim(skill_abr)), '') AS lower_skill FROM b_skills""",
    "clean_number": "SELECT job_id, " + ", ".join(
        f"{number(text(c))} AS {c}"
        for c in ("max_salary", "med_salary", "min_salary", "applies", "views")
    ) + " FROM b_postings",
    "safe_number": f"SELECT company_name, {number('company_name')} AS company_number FROM b_postings",
    "strict_id": f"""SELECT CAST(job_id AS BIGINT) AS job_id, {number('views')} AS views_id
        FROM b_postings""",
    "safe_boolean": """SELECT remote_allowed,
        CASE WHEN lower(remote_allowed) IN ('true','t','yes','y','on','1') THEN TRUE
             WHEN lower(remote_allowed) IN ('false','f','no','n','off','0') THEN FALSE END AS flag
        FROM b_postings""",
    "robust_boolean": f"""SELECT job_id, {flag('remote_allowed')} AS remote_allowed,
        {flag('sponsored')} AS sponsored FROM b_postings""",
    "list_boolean": f"SELECT job_id, type, {listed_flag('inferred')} AS inferred FROM b_benefits",
    "epoch_to_ts": "SELECT job_id, " + ", ".join(
        f"{instant(c)} AS {c}"
        for c in ("original_listed_time", "expiry", "closed_time", "listed_time")
    ) + " FROM b_postings",
    "epoch_to_ts_counts": f"""SELECT company_id, {instant('time_recorded')} AS time_recorded
        FROM b_counts""",
    "normalize_pay_period": f"SELECT job_id, {pay_period('pay_period')} AS pay_period FROM b_postings",
    "normalize_formatted_work_type": f"""SELECT job_id,
        {_words('formatted_work_type', SIX_TYPES)} AS formatted_work_type FROM b_postings""",
    "normalize_experience_level": f"""SELECT job_id, {level('formatted_experience_level')}
        AS formatted_experience_level FROM b_postings""",
    "normalize_work_type": f"""SELECT job_id, {_words('work_type', FIVE_TYPES)} AS work_type
        FROM b_postings""",
    "latest_posting_per_job": KEPT + "kept_postings",
    "latest_posting_undated_last": KEPT + "kept_postings_last",
    "latest_count_per_company": """SELECT company_id, employee_count, follower_count, time_recorded
        FROM kept_counts""",
    "one_benefit_per_job_type": "SELECT * FROM s_benefits",
    "distinct_job_skills": "SELECT * FROM s_skills",
    "distinct_job_industries": "SELECT * FROM s_industries",
    "distinct_company_industries": "SELECT * FROM s_company_industries",
    "distinct_company_specialities": "SELECT * FROM s_company_specialities",
    "flatten_companies": """SELECT company_id, name, description,
        CAST(company_size AS BIGINT) AS company_size, state, country, city, zip_code, address, url
        FROM b_companies""",
    "silver_job_postings": f"SELECT {ALL_POSTING} FROM s_postings",
    "silver_benefits": "SELECT * FROM s_benefits",
    "silver_companies": "SELECT * FROM s_companies",
    "silver_employee_counts": "SELECT * FROM s_counts",
    "silver_job_skills": "SELECT * FROM s_skills",
    "silver_job_industries": "SELECT * FROM s_industries",
    "silver_company_industries": "SELECT * FROM s_company_industries",
    "silver_company_specialities": "SELECT * FROM s_company_specialities",
    "gold_job_postings": f"SELECT {ALL_POSTING} FROM g_postings",
    "gold_job_industries": "SELECT * FROM g_industries",
    "gold_job_skills": "SELECT * FROM g_skills",
    "gold_company_profile": "SELECT * FROM g_profile",
    "gold_job_analytics": "SELECT * FROM analytics",
    "gold_job_analytics_salted": "SELECT * FROM analytics",
    "coverage_industry": """SELECT count(*) AS total, count(industry_id) AS non_null_industry_id
        FROM analytics_gaps""",
    "coverage_company_size": """SELECT count(*) AS total,
        count(company_size) AS non_null_company_size FROM analytics_gaps""",
    "top_titles_per_industry": """SELECT industry_id, title, n AS nb_job_postings FROM title_ranks
        ORDER BY industry_id, n DESC, title""",
    "top_paid_titles_per_industry": """SELECT industry_id, title, mean AS avg_max_salary
        FROM title_mean_ranks ORDER BY industry_id, mean DESC, title NULLS FIRST""",
    "postings_by_company_size": """SELECT company_size, count(*) AS nb_job_postings FROM analytics
        WHERE company_size IS NOT NULL GROUP BY company_size ORDER BY company_size""",
    "companies_by_size": """SELECT company_size, count(*) AS nb_companies FROM g_profile
        WHERE company_size IS NOT NULL GROUP BY company_size ORDER BY company_size""",
    "top_industries": """SELECT industry_id, n AS nb_job_postings FROM industry_counts
        ORDER BY n DESC, industry_id LIMIT 30""",
    "postings_by_contract": """SELECT formatted_work_type, n AS nb_job_postings
        FROM contract_counts ORDER BY n DESC, formatted_work_type""",
    "top_skills": """SELECT skill_abr, count(DISTINCT job_id) AS nb_job_postings FROM g_skills
        WHERE skill_abr IS NOT NULL GROUP BY skill_abr
        ORDER BY nb_job_postings DESC, skill_abr LIMIT 10""",
    "industry_labels": """SELECT job_id, industry_id, coalesce(label, 'Other') AS industry_name
        FROM g_industries LEFT JOIN dimension ON industry_id = code""",
    "panel_top_titles": _panel("labelled_titles", "n", "nb_jobs", "Banking"),
    "panel_top_titles_other": _panel("labelled_titles", "n", "nb_jobs", "Other"),
    "panel_top_salaries": _panel("labelled_means", "mean", "avg_salary", "Banking", "NULLS FIRST"),
    "panel_industry_names": """SELECT DISTINCT industry_name FROM labelled_titles
        ORDER BY industry_name""",
    "panel_salary_industry_names": """SELECT DISTINCT industry_name FROM labelled_means
        ORDER BY industry_name""",
    "dominant_company_size": """
        SELECT company_size, nb_jobs,
               '👉 Most opportunities come from company size: ' || company_size AS sentence
        FROM (SELECT company_size, count(*) AS nb_jobs FROM analytics
              WHERE company_size IS NOT NULL GROUP BY company_size
              ORDER BY nb_jobs DESC, company_size LIMIT 1)""",
    "dominant_industry": """
        SELECT industry_id, industry_name, nb_jobs, format('{:,}', nb_jobs) AS volume,
               '🌍 Industrie dominante : **' || industry_name || '**  ' || chr(10)
               || '📊 Volume : **' || format('{:,}', nb_jobs) || ' offres**' AS sentence
        FROM top10 ORDER BY nb_jobs DESC, industry_id LIMIT 1""",
    "industry_share": f"SELECT *, {BLOCKS} AS blocks FROM shares",
    "waffle_blocks": f"""
        SELECT row_number() OVER (ORDER BY nb_jobs DESC, industry_id) - 1 AS id,
               industry_name AS industry, CAST(1 AS BIGINT) AS value
        FROM (SELECT *, unnest(range({BLOCKS})) AS block FROM shares)""",
    "waffle_legend": f"SELECT DISTINCT industry_name AS industry FROM shares WHERE {BLOCKS} > 0",
    "contract_kpis": """
        SELECT formatted_work_type AS label, n AS value, format('{:,}', n) AS value_text,
               CASE WHEN contains(formatted_work_type, 'Full') THEN '#2563eb'
                    WHEN contains(formatted_work_type, 'Contract') THEN '#f59e0b'
                    WHEN contains(formatted_work_type, 'Part') THEN '#10b981'
                    WHEN contains(formatted_work_type, 'Intern') THEN '#8b5cf6'
                    WHEN contains(formatted_work_type, 'Temp') THEN '#ef4444'
                    WHEN contains(formatted_work_type, 'Volunteer') THEN '#ec4899'
                    ELSE '#64748b' END AS colour
        FROM contract_counts""",
    "csv_bronze_roundtrip": f"SELECT {ALL_POSTING} FROM b_postings",
    "csv_multiline_split": f"""SELECT {ALL_POSTING} FROM (SELECT * REPLACE (concat('"', replace(
        description, ' ', ',' || chr(10)), '",', chr(10), description, chr(10)) AS description)
        FROM b_postings)""",
    "json_array_split": "SELECT * FROM s_industries",
    "json_bronze_roundtrip": "SELECT * FROM s_companies",
    "json_lines_bronze": "SELECT * FROM s_industries",
    "incremental_ingest": "SELECT * FROM b_skills",
    "bronze_batch_then_stream": "SELECT * FROM b_skills",
    "bronze_full_reload": "SELECT * FROM b_skills",
    "json_records_bronze": "SELECT * FROM s_companies",
    "benefits_bronze": "SELECT job_id, inferred, type FROM b_benefits",
    "employee_counts_bronze": """SELECT company_id, employee_count, follower_count, time_recorded
        FROM b_counts""",
    "company_industries_bronze": "SELECT * FROM s_company_industries",
    "company_specialities_bronze": "SELECT * FROM s_company_specialities",
    "store_rebuild": "SELECT * FROM g_skills",
    "namespaced_row_counts": """SELECT 'job_skills' AS "table", count(*) AS rows FROM s_skills
        UNION ALL SELECT 'job_industries', count(*) FROM s_industries""",
    "current_layer_sql": """SELECT skill_abr, count(*) AS pairs, count(DISTINCT job_id) AS jobs
        FROM g_skills GROUP BY skill_abr""",
    "panel_from_stored_layout": _panel("labelled_titles", "n", "nb_jobs", "Banking"),
    "changed_files_load": "SELECT * FROM b_skills WHERE CAST(job_id AS BIGINT) % 3 <> 0",
    "layer_of_one_generation": " UNION ALL ".join(
        f"""SELECT '{moment}' AS moment, '{table}' AS "table", count(*) AS rows FROM {view}{part}"""
        for moment in ("first", "failed", "midway", "last")
        for table, view in (("job_skills", "s_skills"), ("job_industries", "s_industries"))
        for part in ["" if moment == "last" else " WHERE job_id % 2 = 0"]
    ),
    "names_follow_rebuilds": "SELECT skill_abr, count(*) AS pairs FROM g_skills GROUP BY skill_abr",
    "layer_profile": " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", '{column}' AS "column", count(*) AS rows,
            count(*) - count("{column}") AS nulls, TRUE AS near FROM {view}"""
        for table, view, columns in (
            ("job_skills", "s_skills", ("job_id", "skill_abr")),
            ("job_industries", "s_industries_gaps", ("job_id", "industry_id")),
            ("benefits", "s_benefits", ("job_id", "inferred", "type")),
        )
        for column in columns
    ),
    "table_changes": " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(*) FILTER (job_id % 2 = 0) AS rows_before,
            count(*) AS rows, {missing} AS nulls_before, {every} AS nulls, FALSE AS same
            FROM s_industries_gaps"""
        for name, missing, every in (
            ("*", "0", "0"),
            ("job_id", "count(*) FILTER (job_id IS NULL AND job_id % 2 = 0)", "count(*) - count(job_id)"),
            (
                "industry_id",
                "count(*) FILTER (industry_id IS NULL AND job_id % 2 = 0)",
                "count(*) - count(industry_id)",
            ),
        )
    ),
}


def _steps(statement: str) -> list[str]:
    """Names of the views ``statement`` uses, directly or through others, in a valid order."""
    found: list[str] = []
    for name in VIEWS:
        if re.search(rf"(?<!\.)\b(FROM|JOIN)\s+{name}\b", statement):
            found += [s for s in _steps(VIEWS[name]) if s not in found] + [name]
    return list(dict.fromkeys(found))


def sql() -> dict[str, str]:
    statements = {}
    for name, final in FINAL.items():
        steps = ",\n".join(f"{s} AS ({VIEWS[s]})" for s in _steps(final))
        statements[name] = f"WITH {steps}\n{final}"
    return statements
