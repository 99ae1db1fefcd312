"""Labels, keyword lists, patterns and bands.

All of them are plain data.  Every operator takes such a list as a parameter
and only falls back to the one stated here.
"""

NOT_STATED = "Tidak Disebutkan"
UNMAPPED_LOCATION = "Lainnya"
OTHER_ROLE = "Other"
DEFAULT_LOCATION = "DKI Jakarta"
STOP_SKILL = "r"

# Phrases of titles that are not IT jobs.
NOISE_TITLES = [
    "finance intern", "finance staff", "finance analyst", "financial planning",
    "hr intern", "human resources intern", "talent acquisition",
    "marketing intern", "marketing staff",
    "accounting intern", "accounting staff",
    "operations intern", "operation administration",
    "legal intern", "legal staff",
    "cargo crew", "teller", "area manager",
    "actuarial", "management trainee",
    "business development intern", "business development staff",
    "medical", "nurse", "doctor", "pharmacist",
    "sales intern", "sales staff", "sales executive",
    "supply chain", "logistic",
    "internship program", "ignite internship",
    "labs bootcamp", "tlm intern", "flm",
]

# Words of which an IT job description holds at least one.
DOMAIN_WORDS = [
    "software", "developer", "engineer", "data", "programming",
    "python", "javascript", "java", "sql", "database", "cloud",
    "machine learning", "artificial intelligence", "web", "mobile",
    "android", "ios", "backend", "frontend", "fullstack", "devops",
    "analyst", "scientist", "tech", "coding", "api", "system",
    "network", "security", "infrastructure", "agile", "scrum",
]

# Title keywords per standard role, first match wins.
ROLE_KEYWORDS = [
    ("Data Scientist", [
        "data scientist", "ml scientist", "research scientist",
        "data science", "scientist", "nlp engineer", "nlp scientist",
    ]),
    ("Data Analyst", [
        "data analyst", "business analyst", "product analyst",
        "analytics", "bi analyst", "reporting analyst",
        "financial analyst", "market analyst", "marketing analyst",
        "data analytics", "operation analyst", "supply analytics",
        "lead analyst", "bi developer", "business intelligence developer",
        "power bi", "tableau developer", "looker developer",
        "bi development", "bi specialist", "data visualization", "data viz",
        "dashboard developer",
    ]),
    ("Data Engineer", [
        "data engineer", "etl engineer", "data pipeline",
        "analytics engineer", "big data", "data platform",
        "data infrastructure", "data manager", "data collector",
    ]),
    # "AI" is upper case on purpose: titles are lower-cased before the
    # containment test, so it only counts in the similarity fallback.
    ("ML Engineer", [
        "machine learning engineer", "ml engineer", "mlops",
        "ai engineer", "deep learning", "computer vision engineer",
        "llm engineer", "generative ai", "AI",
    ]),
    ("Backend Developer", [
        "backend developer", "back-end developer", "backend engineer",
        "back end developer", "python developer", "java developer",
        "golang developer", "go developer", "php developer",
        "ruby developer", "api developer", "server side developer",
        "node developer", "laravel developer", "spring developer",
    ]),
    ("Frontend Developer", [
        "frontend developer", "front-end developer", "frontend engineer",
        "front end developer", "ui developer", "react developer",
        "vue developer", "angular developer", "web frontend",
        "ui engineer",
    ]),
    ("Fullstack Developer", [
        "fullstack", "full stack", "full-stack",
        "web developer", "web engineer",
    ]),
    ("Software Engineer", [
        "software engineer", "software developer", "programmer",
        "it engineer", "tech lead", "technical lead", "system analyst",
        "systems analyst", "it analyst", "business system analyst",
        "functional analyst", "solution architect", "software architect",
        "qa engineer", "quality assurance", "quality engineer",
        "test engineer", "qa automation", "software tester",
        "automation tester", "sdet",
    ]),
]
ROLE_SIMILARITY_FLOOR = 0.08

# Patterns of search terms per standard role, first match wins.
ROLE_PATTERNS = [
    ("Data Engineer", r"data\s*eng"),
    ("Data Scientist", r"data\s*sci"),
    ("Data Analyst", r"data\s*anal|business\s*anal"),
    ("ML Engineer", r"machine\s*learn|ml\s*eng|ai\s*eng|mlops"),
    ("BI Developer", r"bi\s*dev|business\s*intel|bi\s*eng"),
    ("Frontend Developer", r"frontend|front.end|front\s*end|web\s*dev|ui\s*dev"),
    ("Backend Developer", r"backend|back.end|back\s*end"),
    ("Fullstack Developer", r"fullstack|full.stack|full\s*stack"),
    ("Mobile Developer", r"mobile|android|ios|flutter|react\s*native"),
    ("DevOps Engineer", r"devops|sre|site\s*reliab|platform\s*eng"),
    ("IT Infrastructure", r"sysadmin|system\s*admin|network|infra"),
    ("QA Engineer", r"qa\s*eng|quality\s*assur|tester|testing"),
    ("System Analyst", r"system\s*anal|sys\s*anal|business\s*sys"),
    ("IT Support", r"it\s*support|helpdesk|help\s*desk|technical\s*sup"),
    ("Software Engineer", r"software\s*eng|developer|programmer"),
    ("Cloud Engineer", r"cloud|aws|gcp|azure\s*eng"),
    ("Cybersecurity", r"security|cyber|penetration|pentest"),
    ("Product Manager", r"product\s*man|pm\b"),
    ("Project Manager", r"scrum|agile\s*coach|project\s*man"),
    ("Business Development", r"business\s*dev|biz\s*dev|bd\b"),
]

# Patterns of places per province or country, first match wins.
LOCATION_PATTERNS = [
    ("DKI Jakarta", r"jakarta|jaksel|jakpus|jakbar|jakut|jaktim|jak\b"),
    ("Jawa Barat",
     r"bandung|bekasi|depok|bogor|cimahi|sukabumi|karawang|purwakarta"
     r"|cirebon|tasikmalaya|garut|subang|cianjur|indramayu"),
    ("Banten", r"tangerang|banten|serang|cilegon|serpong|alam\s*sutera"),
    ("Jawa Tengah",
     r"semarang|solo|surakarta|yogyakarta|jogja|magelang|kudus"
     r"|pekalongan|tegal|purwokerto|salatiga|klaten"),
    ("D.I. Yogyakarta", r"yogyakarta|jogja|sleman|bantul|gunung\s*kidul|kulon\s*progo"),
    ("Jawa Timur",
     r"surabaya|malang|sidoarjo|gresik|mojokerto|pasuruan|probolinggo"
     r"|jember|kediri|madiun|blitar|tulungagung|banyuwangi"),
    ("Sumatera Utara", r"medan|deli\s*serdang|binjai|tebing\s*tinggi"),
    ("Sumatera Selatan", r"palembang|prabumulih|lubuklinggau"),
    ("Riau", r"pekanbaru|dumai|riau"),
    ("Kepulauan Riau", r"batam|kepri|kepulauan\s*riau|tanjung\s*pinang"),
    ("Sumatera Barat", r"padang|bukittinggi|sumatera\s*barat"),
    ("Aceh", r"banda\s*aceh|aceh|lhokseumawe"),
    ("Jambi", r"jambi"),
    ("Lampung", r"lampung|bandar\s*lampung"),
    ("Bengkulu", r"bengkulu"),
    ("Kalimantan Timur", r"balikpapan|samarinda|bontang|kaltim|kalimantan\s*timur"),
    ("Kalimantan Selatan", r"banjarmasin|banjarbaru|kalsel|kalimantan\s*selatan"),
    ("Kalimantan Barat", r"pontianak|singkawang|kalbar|kalimantan\s*barat"),
    ("Kalimantan Tengah", r"palangka\s*raya|kalteng|kalimantan\s*tengah"),
    ("Kalimantan Utara", r"tarakan|nunukan|kaltara|kalimantan\s*utara"),
    ("Sulawesi Selatan", r"makassar|sulsel|sulawesi\s*selatan|gowa|maros"),
    ("Sulawesi Utara", r"manado|sulut|sulawesi\s*utara|tomohon|bitung"),
    ("Sulawesi Tengah", r"palu|sulteng|sulawesi\s*tengah"),
    ("Sulawesi Tenggara", r"kendari|sultra|sulawesi\s*tenggara"),
    ("Bali", r"bali|denpasar|badung|gianyar|tabanan|singaraja"),
    ("NTB", r"mataram|lombok|ntb|nusa\s*tenggara\s*barat"),
    ("NTT", r"kupang|ntt|nusa\s*tenggara\s*timur"),
    ("Papua", r"jayapura|papua"),
    ("Maluku", r"ambon|maluku"),
    ("Remote / WFH", r"remote|work\s*from\s*home|wfh|hybrid"),
    ("Singapura", r"singapore|singapura"),
    ("Malaysia", r"malaysia|kuala\s*lumpur|kl\b"),
]

# Patterns of job levels in title and description.
LEVEL_PATTERNS = [
    ("Senior", r"senior|sr\.|lead|principal|staff\s*eng|expert"),
    ("Junior", r"junior|jr\.|entry.level|fresh\s*grad|magang|intern"),
    ("Managerial", r"manager|head|director|vp\b|chief|c[to]o\b"),
    ("Mid", r"mid.level|medior|\bmid\b"),
]

# Title words per seniority (first board's rule).
SENIORITY_WORDS = [
    ("Intern", ["intern", "internship", "magang"]),
    ("Junior", ["junior", "jr.", "entry", "fresh"]),
    ("Senior", ["senior", "sr.", "lead", "principal", "staff"]),
    ("Manager/Head", ["manager", "head", "director", "vp", "chief", "architect"]),
]
SENIORITY_DEFAULT = "Mid-level"

# Title words per seniority (merged table's rule).
TITLE_SENIORITY_WORDS = [
    ("Manager/Head", ["Head", "Director", "VP", "Chief", "Lead", "Principal",
                      "Architect", "Manager"]),
    ("Senior", ["Senior", "Sr.", "Sr "]),
    ("Mid-level", ["Mid", "Associate", "Staff", "Specialist"]),
    ("Junior", ["Junior", "Jr.", "Jr ", "Entry", "Intern", "Magang", "Fresh"]),
]

# Level labels to harmonise.
LEVEL_RENAMES = [
    ("Intern", "Junior"),
    ("Mid|Mid-level", "Mid-level"),
    ("Managerial|Manager/Lead", "Manager/Head"),
]

# Skills matched as whole words.
SKILLS_FULL = [
    "python", "java", "javascript", "typescript", "golang", "go",
    "php", "swift", "kotlin", "scala", "r", "c++", "c#", "rust",
    "dart", "ruby", "bash", "shell", "perl", "html", "css",
    "react", "angular", "vue", "nextjs", "nuxtjs", "django",
    "flask", "fastapi", "spring boot", "express", "nestjs",
    "laravel", "rails", "fiber", "gin", "svelte",
    "tensorflow", "pytorch", "keras", "scikit-learn", "pandas",
    "numpy", "opencv", "huggingface", "transformers", "xgboost",
    "lightgbm", "catboost", "mlflow", "kubeflow", "dvc",
    "langchain", "openai", "llm",
    "sql", "postgresql", "mysql", "mongodb", "redis",
    "elasticsearch", "cassandra", "dynamodb", "firebase",
    "mariadb", "sqlite", "neo4j", "supabase", "bigquery",
    "aws", "gcp", "azure", "docker", "kubernetes", "k8s",
    "jenkins", "gitlab ci", "github actions", "terraform",
    "ansible", "prometheus", "grafana", "helm", "argocd",
    "circleci", "ci/cd",
    "hadoop", "spark", "kafka", "airflow", "databricks",
    "snowflake", "dbt", "hive", "flink", "beam",
    "tableau", "power bi", "looker", "metabase", "superset", "qlik",
    "flutter", "android", "ios", "react native", "xamarin",
    "agile", "scrum", "kanban", "git", "linux", "rest api",
    "graphql", "microservices", "tdd", "oop", "solid",
]

# Skills matched by plain containment while collecting.  One of
# the two boards also looks for "laravel".
SKILLS_SHORT = [
    "python", "java", "javascript", "typescript", "golang", "php", "swift",
    "kotlin", "scala", "c++", "c#", "rust", "react", "angular", "vue",
    "django", "flask", "fastapi", "spring boot", "express", "tensorflow",
    "pytorch", "keras", "scikit-learn", "pandas", "numpy", "sql",
    "postgresql", "mysql", "mongodb", "redis", "elasticsearch", "aws", "gcp",
    "azure", "docker", "kubernetes", "hadoop", "spark", "kafka", "airflow",
    "tableau", "power bi", "flutter", "android", "ios", "agile", "scrum",
    "git", "linux", "bash",
]
SKILLS_SHORT_WITH_LARAVEL = SKILLS_SHORT + ["laravel"]

# Orders of categories in reports.
ROLE_ORDER = [
    "Backend Developer", "Frontend Developer", "Fullstack Developer",
    "Data Analyst", "Data Engineer", "Data Scientist",
    "ML Engineer", "DevOps Engineer", "Software Engineer",
]
LEVEL_ORDER = ["Junior", "Mid-level", "Senior", "Manager/Head", NOT_STATED]

# Right-closed bands (low, high, label); the last has no upper end.
COMPANY_SIZE_BANDS = [
    (0, 2, "Small (1–2)"),
    (2, 5, "Medium (3–5)"),
    (5, 10, "Large (6–10)"),
    (10, None, "Enterprise (10+)"),
]
SKILL_COUNT_BANDS = [
    (0, 2, "0–2"),
    (2, 4, "3–4"),
    (4, 6, "5–6"),
    (6, 8, "7–8"),
    (8, None, "9+"),
]

# Plausible monthly salary in rupiah, and smallest amount that a
# number without unit may mean.
SALARY_LOW = 1_000_000
SALARY_HIGH = 100_000_000
SALARY_TEXT_FLOOR = 100_000

# Column orders of the hand-over tables.
BOARD_B_COLUMNS = [
    "id", "title", "search_role", "search_role_raw", "job_level",
    "company", "location", "location_raw",
    "salary_display", "salary_min", "salary_max", "salary_avg",
    "extracted_skills", "skills_count",
    "job_url", "job_description", "search_location", "scraped_at",
]
BOARD_A_COLUMNS = [
    "id", "title", "standardized_role", "company", "location",
    "seniority", "jd_length",
    "job_description", "extracted_skills", "skills_count",
    "job_url", "search_role", "search_location",
]
ANALYSIS_COLUMNS = [
    "id", "title", "search_role", "job_level", "company",
    "location", "salary_avg", "extracted_skills",
    "skills_count", "job_description", "job_url", "scraped_at",
]
