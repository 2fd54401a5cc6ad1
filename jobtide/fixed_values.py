"""Names, codes, thresholds and word lists the results depend on.

Everything here is data, kept in plain text and natural order so that it can be checked by eye.
"""

from __future__ import annotations

# --- data sources -------------------------------------------------------------------------

LINKEDIN = "kaggle_linkedin"
LINKEDIN_LARGE = "kaggle_linkedin_large"
DATA_SCIENCE = "kaggle_ds"
LIVE = "adzuna"
SOURCES = [LINKEDIN, LINKEDIN_LARGE, DATA_SCIENCE, LIVE]

# --- economic series: id, readable name -----------------------------------------------------

LABOR_SERIES = [
    ("LNS14000000", "unemployment rate"),
    ("CES0000000001", "total nonfarm employment"),
    ("CES6500000001", "tech sector employment"),
    ("LNS11300060", "labor force participation 25-54"),
    ("LNS12300060", "employment-population ratio 25-54"),
    ("JTS000000000000000JOL", "jolts job openings"),
    ("JTS000000000000000HIR", "jolts hires"),
    ("JTS000000000000000QUL", "jolts quits"),
    ("JTS000000000000000LDL", "jolts layoffs and discharges"),
    ("JTS000000000000000TSL", "jolts total separations"),
]

MACRO_SERIES = [
    ("UNRATE", "unemployment rate"),
    ("JTSJOL", "jolts job openings"),
    ("CPIAUCSL", "consumer price index"),
    ("FEDFUNDS", "federal funds rate"),
    ("ICSA", "initial jobless claims"),
    ("RSXFS", "retail sales ex food services"),
    ("PAYEMS", "total nonfarm payrolls"),
    ("EMRATIO", "employment-population ratio"),
    ("LNS12300060", "prime-age employment-population ratio"),
    ("CIVPART", "labor force participation rate"),
    ("OPHNFB", "nonfarm business labor productivity"),
    ("UEMPLT5", "unemployed less than 5 weeks"),
    ("UEMP27OV", "unemployed 27 weeks and over"),
    ("PCEPI", "pce price index"),
    ("DFF", "effective federal funds rate"),
]

SERIES_CATEGORIES = {
    "employment": [
        "unemployment rate",
        "total nonfarm employment",
        "tech sector employment",
        "total nonfarm payrolls",
        "employment-population ratio",
        "prime-age employment-population ratio",
        "labor force participation rate",
        "labor force participation 25-54",
        "employment-population ratio 25-54",
    ],
    "labor_demand": [
        "jolts job openings",
        "jolts hires",
        "jolts quits",
        "jolts layoffs and discharges",
        "jolts total separations",
        "initial jobless claims",
    ],
    "inflation": [
        "consumer price index",
        "pce price index",
        "federal funds rate",
        "effective federal funds rate",
    ],
    "productivity": ["nonfarm business labor productivity"],
    "consumer": ["retail sales ex food services"],
    "unemployment_duration": ["unemployed less than 5 weeks", "unemployed 27 weeks and over"],
}

# --- metro profiles: census variable, column name, type ---------------------------------------

METRO_KEY = "metropolitan statistical area/micropolitan statistical area"

METRO_VARIABLES = [
    ("DP03_0003PE", "pct_civilian_labor_force", "double"),
    ("DP03_0004PE", "pct_employed", "double"),
    ("DP03_0005PE", "pct_unemployed", "double"),
    ("DP03_0009PE", "unemployment_rate", "double"),
    ("DP03_0021PE", "pct_public_transportation_commute", "double"),
    ("DP03_0024PE", "pct_work_from_home", "double"),
    ("DP03_0025E", "mean_commute_minutes", "double"),
    ("DP03_0027PE", "pct_mgmt_business_science_arts", "double"),
    ("DP03_0039PE", "pct_information_industry", "double"),
    ("DP03_0040PE", "pct_finance_real_estate_rental_leasing", "double"),
    ("DP03_0041PE", "pct_professional_scientific_management_admin_waste", "double"),
    ("DP02_0067PE", "pct_high_school_or_higher", "double"),
    ("DP02_0068PE", "pct_bachelors_or_higher", "double"),
    ("DP02_0154PE", "pct_broadband", "double"),
    ("DP03_0062E", "median_household_income", "int"),
    ("DP03_0093E", "median_earnings_male_ft_yr_round", "int"),
    ("DP03_0094E", "median_earnings_female_ft_yr_round", "int"),
    ("DP03_0119PE", "poverty_rate_families", "double"),
    ("DP03_0128PE", "poverty_rate_all_people", "double"),
]

# Metros whose profiles are kept, and the city each one is reached through.
METRO_BRIDGE = [
    ("texas", "austin", "12420"),
    ("california", "san francisco", "41860"),
    ("california", "san jose", "41940"),
    ("washington", "seattle", "42660"),
    ("new york", "new york", "35620"),
    ("massachusetts", "boston", "14460"),
    ("virginia", "washington", "47900"),
    ("colorado", "denver", "19740"),
    ("california", "los angeles", "31080"),
    ("illinois", "chicago", "16980"),
    ("texas", "dallas", "19100"),
    ("georgia", "atlanta", "12060"),
    ("north carolina", "raleigh", "39580"),
    ("minnesota", "minneapolis", "33460"),
    ("arizona", "phoenix", "38060"),
]

# --- education levels, by category number 1..12 -------------------------------------------------

EDUCATION_LEVELS = [
    "pct_less_than_high_school",
    "pct_high_school_diploma",
    "pct_postsecondary_certificate",
    "pct_some_college",
    "pct_associates_degree",
    "pct_bachelors_degree",
    "pct_post_baccalaureate_certificate",
    "pct_masters_degree",
    "pct_post_masters_certificate",
    "pct_first_professional_degree",
    "pct_doctoral_degree",
    "pct_post_doctoral_training",
]

# --- skill names: variant, canonical form --------------------------------------------------------

SKILL_VARIANTS = [
    ("problemsolving", "problem solving"),
    ("problem-solving", "problem solving"),
    ("communication skills", "communication"),
    ("verbal communication", "communication"),
    ("written communication", "communication"),
    ("oral communication", "communication"),
    ("interpersonal skills", "communication"),
    ("interpersonal communication", "communication"),
    ("strong communication", "communication"),
    ("effective communication", "communication"),
    ("verbal and written communication", "communication"),
    ("written and verbal communication", "communication"),
    ("oral and written communication", "communication"),
    ("organizational skills", "organization"),
    ("organisational skills", "organization"),
    ("time-management", "time management"),
    ("team work", "teamwork"),
    ("team-work", "teamwork"),
    ("team player", "teamwork"),
    ("analytical skills", "analytical thinking"),
    ("analytical thinking skills", "analytical thinking"),
    ("critical-thinking", "critical thinking"),
    ("problem analysis", "analytical thinking"),
    ("data-analysis", "data analysis"),
    ("data analytics", "data analysis"),
    ("project-management", "project management"),
    ("programme management", "project management"),
    ("program management", "project management"),
    ("customer-service", "customer service"),
    ("client service", "customer service"),
    ("customer support", "customer service"),
    ("ms office", "microsoft office"),
    ("ms office suite", "microsoft office"),
    ("microsoft office suite", "microsoft office"),
    ("ms excel", "excel"),
    ("microsoft excel", "excel"),
    ("ms word", "microsoft word"),
    ("ms powerpoint", "microsoft powerpoint"),
    ("power point", "microsoft powerpoint"),
    ("power bi", "power bi"),
    ("powerbi", "power bi"),
    ("tableau software", "tableau"),
    ("sql server", "sql server"),
    ("ms sql server", "sql server"),
    ("ms sql", "sql server"),
    ("amazon web services", "aws"),
    ("amazon web services (aws)", "aws"),
    ("google cloud platform", "gcp"),
    ("google cloud", "gcp"),
    ("azure cloud", "microsoft azure"),
    ("ms azure", "microsoft azure"),
    ("machine-learning", "machine learning"),
    ("deep-learning", "deep learning"),
    ("artificial intelligence", "ai"),
    ("artificial intelligence (ai)", "ai"),
    ("machine learning (ml)", "machine learning"),
    ("natural language processing", "nlp"),
    ("natural language processing (nlp)", "nlp"),
    ("ci/cd", "ci cd"),
    ("continuous integration/continuous delivery", "ci cd"),
    ("continuous integration/continuous deployment", "ci cd"),
    ("dev ops", "devops"),
    ("dev-ops", "devops"),
    ("react.js", "react"),
    ("reactjs", "react"),
    ("react js", "react"),
    ("node.js", "node.js"),
    ("nodejs", "node.js"),
    ("angular.js", "angular"),
    ("angularjs", "angular"),
    ("vue.js", "vue"),
    ("vuejs", "vue"),
    ("type script", "typescript"),
    ("java script", "javascript"),
    ("c sharp", "c#"),
    ("c #", "c#"),
    ("c plus plus", "c++"),
    ("dot net", ".net"),
    (".net framework", ".net"),
    ("asp.net", ".net"),
    ("mongo db", "mongodb"),
    ("postgres", "postgresql"),
    ("postgre sql", "postgresql"),
    ("my sql", "mysql"),
    ("no sql", "nosql"),
    ("apache spark", "spark"),
    ("apache kafka", "kafka"),
    ("apache airflow", "airflow"),
    ("apache hadoop", "hadoop"),
    ("spring boot", "spring boot"),
    ("spring framework", "spring boot"),
    ("html5", "html"),
    ("html / css", "html css"),
    ("html/css", "html css"),
    ("css3", "css"),
    ("git hub", "github"),
    ("graphic design", "graphic design"),
    ("ui/ux", "ui ux design"),
    ("ux/ui", "ui ux design"),
    ("ui ux", "ui ux design"),
    ("ux design", "ui ux design"),
    ("ui design", "ui ux design"),
    ("user experience", "ui ux design"),
    ("user interface design", "ui ux design"),
    ("agile methodology", "agile"),
    ("agile methodologies", "agile"),
    ("scrum methodology", "scrum"),
    ("lean six sigma", "six sigma"),
    ("six-sigma", "six sigma"),
    ("supply-chain", "supply chain management"),
    ("supply chain", "supply chain management"),
    ("financial-analysis", "financial analysis"),
    ("financial modeling", "financial analysis"),
    ("book keeping", "bookkeeping"),
    ("book-keeping", "bookkeeping"),
    ("auto cad", "autocad"),
    ("solid works", "solidworks"),
]

# --- noise among skill names: LIKE patterns, any match removes the name ----------------------------

SKILL_LENGTHS = (2, 50)

NOISE_PATTERNS = [
    # licences and certificates
    "%license%", "%licensure%", "%licens%", "%certification%", "%certified %", "%accredit%",
    "%credential%",
    # degrees
    "%degree%", "%diploma%", "%bachelor%", "%master's%", "%doctorate%", "%ged%",
    "%accredited school%", "%graduate of%", "%graduate from%",
    # age
    "%years of age%", "%years old%", "%or older%", "%18+%", "%21+%", "%must be 18%",
    "%must be 21%", "%at least 18%", "%at least 21%", "%minimum 18%",
    # legal text
    "%equal opportunity%", "%affirmative action%", "%eeo/%", "%eeo %", "%reasonable accommod%",
    "%authorized to work%", "%eligib%to work%", "%authorization to work%", "%legal%to work%",
    "%disability%", "%protected veteran%", "%background check%", "%drug test%", "%drug screen%",
    "%security clearance%", "%u.s. citizen%", "%us citizen%", "%citizenship%", "%covid%",
    "%vaccination%",
    # benefits
    "%insurance%", "%reimbursement%", "%paid time off%", "%401k%", "%401(k)%", "%pto%",
    "%vacation%", "%tuition%", "%stipend%", "%discount%", "%company paid%", "%company-paid%",
    "%career advance%", "%career opportun%", "%adoption%", "%fertility%", "%childcare%",
    "%child care%", "%parenting%", "%weight loss%", "%tobacco%", "%wellness%televis%",
    # logistics
    "%driver%license%", "%driving license%", "%chauffeur%", "%valid license%", "%clean driv%",
    "%motor vehicle%", "%able to lift%", "%pounds%", "%standing and walking%",
    "%weather conditions%", "%climbing up to%", "%toxic%caustic%", "%warehouse environment%",
    # attitudes
    '%"can do"%', "%can do%attributes%", "%can-do attitude%", "%hard worker%", "%fast learner%",
    "%go-getter%", "%self-starter%", "%self starter%", "%detail-oriented%", "%detail oriented%",
    # policies
    "%company policies%", "%policies and procedures%", "%labor laws%", "%legal requirements%",
    # phrases
    "%excellent %and%", "%strong %and%", "%effective %and%", "%good %and%",
    "%proficiency in %and%", "%proof of%", "%exposure to%",
    # shop floor
    "%planogram%", "%cash register%", "%flatbed scanner%", "%merchandise presentation%",
    "%countertop%", "%restocking%", "%restock%", "%refunds and overrides%", "%drawer pulls%",
    "%cartons and totes%", "%collect payment%", "%collecting payment%",
    "%itemizing and totaling%", "%monitoring cameras%", "%secure shopping%", "%secure working%",
    "%customer service leadership%",
    # single employers
    "%archways to opportunity%", "%weatherby healthcare%", "%mayo clinic%", "%women owned%",
    "%irs reassignment%",
    # military
    "%canadian forces%", "%military officer%",
    # nurseries
    "%early years%",
    # stakeholder phrases; the first is the only one bound to the start
    "stakeholder %", "%stakeholder relationship%", "%stakeholder communication%",
    "%stakeholder collaboration%", "%stakeholder coordination%", "%stakeholder liaison%",
    "%stakeholder influence%", "%stakeholder analysis%", "%stakeholder interviews%",
    "%stakeholder consultation%", "%stakeholder alignment%", "%stakeholder identification%",
]

NOISE_NAMES = [
    "stakeholder",
    "stakeholders",
    "internal stakeholders",
    "external stakeholders",
    "key stakeholders",
    "business stakeholders",
    "project stakeholders",
    "shareholder",
    "shareholder opportunity",
    "shareholder eligibility",
    "shareholder track",
    "shareholder opportunities",
]

# --- report of suspected non-skills ---------------------------------------------------------------

SUSPECT_SKILL_PATTERNS = [
    "%degree%", "%years%", "%older%", "%attributes%", "%required%", "%license%", "%must%",
    "%ability to%",
]
SUSPECT_SKILL_LENGTH = 40

# --- labels of the coverage report -----------------------------------------------------------------

COVERAGE_LABELS = [
    ("postings_with_salary", "Has salary"),
    ("remote_postings", "Remote"),
    ("soc_matched_postings", "SOC matched"),
]
