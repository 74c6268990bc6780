"""Posting layout, gates, section names, labels and bundled word lists.

A posting is one delimited line; fields are known only by position. The constants here name those
positions and the gates the jobs use on the number of fields.
"""

from __future__ import annotations

# Positions of the named fields in a posting line (0-based). Positions 0-3 are never read.
POS_SALARY = 4
POS_ADDRESS = 5
POS_COMPANY_TYPE = 6
POS_COMPANY_SIZE = 7
POS_EXPERIENCE = 8
POS_EDUCATION = 9
POS_SKILLS = 10

FIELD_POSITIONS = {
    "salary": POS_SALARY,
    "address": POS_ADDRESS,
    "company_type": POS_COMPANY_TYPE,
    "company_size": POS_COMPANY_SIZE,
    "experience": POS_EXPERIENCE,
    "education": POS_EDUCATION,
    "skills": POS_SKILLS,
}

POSTING_COLUMNS = ["id", "n_fields", *FIELD_POSITIONS]

# Field-count gates used by the jobs.
GATE_STREAM_SALARY = 5       # rows with a salary field (stream)
GATE_DIMENSIONS = 10         # rows through education (batch dimensions)
GATE_FULL = 11               # complete rows (salary batch, keywords, stream dimensions and skills)
GATE_WORD_COUNT_ABOVE = 10   # word-count job keeps rows with more than 10 fields

# Default salary grids (start, end, step).
BATCH_GRID = (0, 40000, 5000)
STREAM_GRID = (0, 40000, 3000)

# Salary sides: which end of "lo-hi" is bucketed.
FLOOR = 0
CEILING = 1

# ---------------------------------------------------------------------------------------------
# These must equal the reference's for equal results.
# ---------------------------------------------------------------------------------------------

# Dimension columns with their result-store qualifiers and display labels, by position 5..9.
DIMENSIONS = [
    # (column, qualifier, label)
    ("address", "address", "地址"),
    ("company_type", "companyType", "公司类型"),
    ("company_size", "companyPnum", "公司规模"),
    ("experience", "experience", "经验"),
    ("education", "education", "学历"),
]

# Cohort of the second salary histogram.
COHORT_EXPERIENCE = "1-3年"
COHORT_EDUCATION = "本科"

# Result-store layout.
STORE_FAMILY = "info"
DEFAULT_DICTIONARY_NAME = "bg"

# Streaming report sections (key suffix after "<job>:").
SECTION_SALARY_FLOOR = "可能实际情况下的工资"
SECTION_SALARY_CEILING = "理想状态下的工资"
SECTION_SKILLS = "职位要求分析"
SECTION_OTHER = "其他"

# Default keyword dictionary (29 entries, in file order).
DEFAULT_KEYWORDS = [
    "hadoop", "mapreduce", "spark", "storm", "hive", "impala", "elasticsearch", "redis", "hbase",
    "kafka", "flume", "sqoop", "scala", "java", "python", "shell", "azkaban", "mysql", "oracle",
    "activemq", "rabbitmq", "rocketmq", "linux",
    "数据仓库", "数据清洗", "数据挖掘", "数据分析", "数据结构", "算法",
]

# Extension words of the segmenter configuration (4 entries).
EXTENSION_WORDS = ["编程思想", "专科", "专科以上", "本科以上"]

# Stop words of the segmenter configuration (76 entries, in file order).
STOP_WORDS = [
    "a", "b", "c", "d", "e", "f", "g", "h", "i", "j", "k", "l", "m", "n", "o", "p", "q", "r", "s",
    "t", "u", "v", "w", "x", "y", "z",
    "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no",
    "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they",
    "this", "to", "was", "will", "with", "http", "com", "htm",
    "1", "2", "3", "4", "5", "6", "7", "8", "9",
    "地", "的", "我", "你", "有", "师",
]
