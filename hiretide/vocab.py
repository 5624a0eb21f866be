"""Value lists the results depend on.

Fixed values: the entries and their order decide which label wins, how tags are
ordered and which sample posting an id maps to, so they are stated here as they
must be and used everywhere else by name.
"""

# Keywords in tag order; "docker" stands twice on purpose (see
# ``distinct`` in hiretide.functions.tags).
TECH_KEYWORDS = (
    "python", "sql", "postgres", "docker", "java", "spring", "aws", "kafka", "typescript",
    "react", "node", "docker", "dbt", "airflow", "go", "kubernetes", "scala", "spark",
)

# Role labels as stored, in the order in which they are tried.
ROLE_LABELS = (
    "Backend Engineer", "Frontend Engineer", "Full Stack Engineer", "Data Engineer",
    "Software Engineer", "Data Scientist", "Analytics Engineer", "Platform Engineer",
    "Machine Learning Engineer", "Devops Engineer",
)
OTHER_ROLE = "Other"

# (text searched for in the lower-cased title, label stored)
ROLE_RULES = tuple((label.lower(), label) for label in ROLE_LABELS)

# The lists sample postings are drawn from.
SAMPLE_COMPANIES = (
    "Acme", "Globex", "Initech", "Stark Labs", "Wayfinder", "Blue Peak", "Northstar",
    "Pioneer Data", "Nimbus", "Vertex", "Cedar Systems", "Redwood Analytics", "Summit Tech",
    "Atlas AI", "Ironclad",
)
SAMPLE_TITLES = (
    "Backend Engineer", "Frontend Engineer", "Full Stack Engineer", "Data Engineer",
    "Software Engineer", "Data Scientist", "Analytics Engineer", "Platform Engineer",
    "Machine Learning Engineer", "DevOps Engineer",
)
SAMPLE_LOCATIONS = (
    "Remote", "Chicago, IL", "New York, NY", "Austin, TX", "Seattle, WA", "San Francisco, CA",
    "Boston, MA", "Denver, CO", "Atlanta, GA", "Madison, WI",
)
SAMPLE_TECH_GROUPS = (
    ("python", "sql", "postgres", "docker"),
    ("java", "spring", "aws", "kafka"),
    ("typescript", "react", "node", "docker"),
    ("python", "spark", "kafka", "aws"),
    ("python", "sql", "dbt", "airflow"),
    ("go", "kubernetes", "docker", "aws"),
    ("scala", "spark", "kafka", "postgres"),
    ("python", "react", "postgres", "docker"),
)
SAMPLE_DESCRIPTIONS = (
    "Build and maintain distributed data services using {techs}.",
    "Develop internal analytics tooling and production services with {techs}.",
    "Own ETL and event-driven workflows using {techs}.",
    "Work on customer-facing features and backend APIs built with {techs}.",
    "Improve platform reliability, observability, and deployments with {techs}.",
)
SAMPLE_URL_BASE = "https://jobs.example.com/"
