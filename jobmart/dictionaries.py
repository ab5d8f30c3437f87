"""Dictionaries that drive enrichment.

Everything under "FIXED VALUES" must equal the values the original job-market ETL
ships with, because results (skill sets, seniority, locations, phrases) depend on
them.  They are plain data; the functions below only reshape them into rows or
patterns.  Users extend them by passing their own dicts to the operators (U01).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original configuration)
# ---------------------------------------------------------------------------

# category -> skill name -> keywords, in this order.
SKILL_DICTIONARY: dict[str, dict[str, list[str]]] = {
    "programming_languages": {
        "Python": ["python", "py"],
        "SQL": ["sql", "mysql", "postgresql", "mssql", "sqlite"],
        "R": ["r", "rstudio"],
        "Java": ["java"],
        "Scala": ["scala"],
        "JavaScript": ["javascript", "js", "node.js"],
    },
    "bi_tools": {
        "Power BI": ["power bi", "powerbi"],
        "Tableau": ["tableau"],
        "Looker": ["looker"],
        "Qlik Sense": ["qlik sense", "qliksense"],
        "Google Data Studio": ["google data studio", "looker studio"],
        "Excel": ["excel", "ms excel"],
    },
    "cloud_platforms": {
        "AWS": ["aws", "amazon web services"],
        "Azure": ["azure", "microsoft azure"],
        "GCP": ["gcp", "google cloud platform"],
        "Snowflake": ["snowflake"],
        "Databricks": ["databricks"],
        "Redshift": ["redshift"],
        "BigQuery": ["bigquery"],
    },
    "databases": {
        "PostgreSQL": ["postgresql", "postgres"],
        "MySQL": ["mysql"],
        "SQL Server": ["sql server", "mssql"],
        "MongoDB": ["mongodb", "mongo db"],
        "Oracle DB": ["oracle db", "oracle database"],
        "Elasticsearch": ["elasticsearch"],
    },
    "big_data_technologies": {
        "Spark": ["spark", "apache spark"],
        "Hadoop": ["hadoop", "apache hadoop"],
        "Kafka": ["kafka", "apache kafka"],
        "Flink": ["flink", "apache flink"],
    },
    "etl_tools": {
        "Airflow": ["airflow", "apache airflow"],
        "Luigi": ["luigi"],
        "Talend": ["talend"],
        "SSIS": ["ssis"],
    },
    "version_control": {
        "Git": ["git", "github", "gitlab", "bitbucket"],
    },
    "statistics_ml": {
        "Pandas": ["pandas"],
        "NumPy": ["numpy", "num py"],
        "Scikit-learn": ["scikit-learn", "sklearn"],
        "TensorFlow": ["tensorflow"],
        "Keras": ["keras"],
        "PyTorch": ["pytorch"],
        "Statsmodels": ["statsmodels"],
        "A/B Testing": ["a/b testing", "ab testing"],
        "Regression": ["regression", "hồi quy"],
        "Classification": ["classification", "phân loại"],
        "Clustering": ["clustering"],
    },
    "soft_skills": {
        "Communication": ["communication", "communicating", "communicator", "giao tiếp"],
        "Problem Solving": ["problem solving", "problem-solving", "problem-solver"],
        "Teamwork": ["teamwork", "team player"],
        "Critical Thinking": ["critical thinking"],
        "Attention to Detail": ["attention to detail", "tỉ mỉ"],
        "Adaptability": ["adaptability", "adaptable", "học hỏi"],
    },
}

# category -> skill type stored in ``skills.skill_category``; anything else is "Other".
CATEGORY_TYPES: dict[str, str] = {
    "programming_languages": "Language",
    "bi_tools": "Tool",
    "cloud_platforms": "Platform",
    "databases": "Database",
    "big_data_technologies": "Technology",
    "etl_tools": "Tool",
    "version_control": "Tool",
    "statistics_ml": "Skill",
    "soft_skills": "Soft Skill",
}
OTHER_CATEGORY = "Other"

# level -> keywords
SENIORITY_LEVELS: dict[str, list[str]] = {
    "intern": ["intern", "thực tập sinh"],
    "junior": ["junior", "fresher", "entry"],
    "mid_level": ["mid", "experienced", "chuyên viên", "3 năm", "4 năm", "3+"],
    "senior": ["senior", "lead", "trưởng nhóm", "5+", "5 năm"],
    "manager_lead": ["manager", "lead", "quản lý", "trưởng phòng"],
    "director_vp": ["director", "vice president", "phó giám đốc", "giám đốc"],
}

# levels are tried in this order; the first level with a keyword hit wins
SENIORITY_PRIORITY: list[str] = [
    "director_vp", "manager_lead", "senior", "mid_level", "junior", "intern",
]

# level -> (min, max) monthly salary in VND
SENIORITY_SALARY_RANGES: dict[str, tuple[int, int]] = {
    "intern": (1_000_000, 5_000_000),
    "junior": (5_000_000, 15_000_000),
    "mid_level": (12_000_000, 25_000_000),
    "senior": (20_000_000, 40_000_000),
    "manager_lead": (30_000_000, 60_000_000),
    "director_vp": (50_000_000, 100_000_000),
}

# canonical location -> aliases (compared after lower + strip)
LOCATION_ALIASES: dict[str, list[str]] = {
    "hà nội": ["hà nội", "ha noi", "hanoi", "hn"],
    "hồ chí minh": ["hồ chí minh", "ho chi minh", "hcm", "hochiminh", "tp hồ chí minh", "tp hcm", "tphcm", "saigon"],
    "đà nẵng": ["đà nẵng", "da nang", "danang", "dn"],
    "hải phòng": ["hải phòng", "hai phong", "hp"],
    "cần thơ": ["cần thơ", "can tho", "ct"],
    "quảng ninh": ["quảng ninh", "quang ninh", "qn"],
    "bình dương": ["bình dương", "binh duong", "bd"],
    "bình phước": ["bình phước", "binh phuoc"],
    "đồng nai": ["đồng nai", "dong nai"],
    "long an": ["long an", "la"],
    "tiền giang": ["tiền giang", "tien giang"],
    "hậu giang": ["hậu giang", "hau giang"],
    "vĩnh long": ["vĩnh long", "vinh long"],
    "an giang": ["an giang", "ag"],
    "kiên giang": ["kiên giang", "kien giang"],
    "cà mau": ["cà mau", "ca mau", "cm"],
    "sóc trăng": ["sóc trăng", "soc trang"],
    "bạc liêu": ["bạc liêu", "bac lieu"],
    "thừa thiên huế": ["thừa thiên huế", "thua thien hue", "tth"],
    "quảng trị": ["quảng trị", "quang tri"],
    "quảng bình": ["quảng bình", "quang binh"],
    "hà tĩnh": ["hà tĩnh", "ha tinh"],
    "nghệ an": ["nghệ an", "nghe an"],
    "thanh hóa": ["thanh hóa", "thanh hoa"],
    "hòa bình": ["hòa bình", "hoa binh"],
    "sơn la": ["sơn la", "son la"],
    "yên bái": ["yên bái", "yen bai"],
    "lạng sơn": ["lạng sơn", "lang son"],
    "cao bằng": ["cao bằng", "cao bang"],
    "bắc kạn": ["bắc kạn", "bac kan"],
    "tuyên quang": ["tuyên quang", "tuyen quang"],
    "phú thọ": ["phú thọ", "phu tho"],
    "vĩnh phúc": ["vĩnh phúc", "vinh phuc"],
    "hưng yên": ["hưng yên", "hung yen"],
    "hải dương": ["hải dương", "hai duong"],
    "nam định": ["nam định", "nam dinh"],
    "ninh bình": ["ninh bình", "ninh binh"],
    "ninh thuận": ["ninh thuận", "ninh thuan"],
    "khánh hòa": ["khánh hòa", "khanh hoa"],
    "phú yên": ["phú yên", "phu yen"],
    "gia lai": ["gia lai", "gl"],
    "đắk lắk": ["đắk lắk", "dak lak"],
    "đắk nông": ["đắk nông", "dak nong"],
    "lâm đồng": ["lâm đồng", "lam dong"],
}

# substrings removed from cleaned descriptions (no word boundary)
BOILERPLATE: list[str] = ["chi tiết", "gợi ý", "báo xấu", "nộp đơn", "chia sẻ"]

# words dropped by the key-phrase extractor
STOP_WORDS: list[str] = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "by", "from", "up", "about", "into", "through", "during",
    "là", "cái", "của", "và", "hoặc", "nhưng", "trong", "tại", "với", "có",
]

# labels inside a cleaned description (company, location, update date)
LABEL_COMPANY = "công ty"
LABEL_LOCATION = "địa điểm"
LABEL_POSTED = "ngày cập nhật"

# words that mark a cleaned description too long to keep: length >= this
MAX_WORD_CHARS = 100

# key phrases: texts shorter than this give none; words must be longer than 3 chars
KEY_PHRASE_MIN_TEXT = 50
KEY_PHRASE_MIN_WORD = 4

# relevance
SEMANTIC_THRESHOLD = 0.3

# crawling: one listing-URL scheme per platform, the prefix a topcv detail link
# must carry, and the default caps
PLATFORMS: list[str] = ["careerviet", "topcv", "vieclam24h"]
LIST_URL_BASE: dict[str, str] = {
    "careerviet": "https://www.careerviet.vn/viec-lam",
    "topcv": "https://www.topcv.vn/tim-viec-lam",
    "vieclam24h": "https://vieclam24h.vn/tim-kiem-viec-lam-nhanh?",
}
TOPCV_JOB_PREFIX = "https://www.topcv.vn/viec-lam/"
DEFAULT_MAX_PAGES = 10
DEFAULT_MAX_RESULTS = 500

# ---------------------------------------------------------------------------
# Reshaping helpers
# ---------------------------------------------------------------------------


def category_type(category: str, types: dict[str, str] | None = None) -> str:
    return (CATEGORY_TYPES if types is None else types).get(category, OTHER_CATEGORY)


def skill_entries(dictionary: dict[str, dict[str, list[str]]] | None = None,
                  types: dict[str, str] | None = None) -> list[tuple[int, str, str, list[str]]]:
    """(order, skill_name, skill_type, keywords) per dictionary entry, in order.

    A skill name may stand under several categories; the extractor reports the
    first of its entries that matches."""
    out: list[tuple[int, str, str, list[str]]] = []
    for category, skills in (SKILL_DICTIONARY if dictionary is None else dictionary).items():
        for name, keywords in skills.items():
            out.append((len(out), name, category_type(category, types), [k.lower() for k in keywords]))
    return out


def keyword_rows(dictionary: dict[str, dict[str, list[str]]] | None = None) -> list[tuple[int, str, str, str]]:
    """(order, category, skill_name, keyword) for every keyword, in dictionary order."""
    rows = []
    for category, skills in (SKILL_DICTIONARY if dictionary is None else dictionary).items():
        for name, keywords in skills.items():
            for keyword in keywords:
                rows.append((len(rows), category, name, keyword.lower()))
    return rows


def alias_map(aliases: dict[str, list[str]] | None = None) -> dict[str, str]:
    """alias -> canonical; the first canonical listing an alias wins."""
    out: dict[str, str] = {}
    for canonical, names in (LOCATION_ALIASES if aliases is None else aliases).items():
        for name in names:
            out.setdefault(name, canonical)
    return out
