"""Texts and constants that reports and rules must carry verbatim."""

# Day names by day of week, 0 = Sunday, and the label of any other number.
DAY_NAMES = {
    0: "Chủ Nhật",
    1: "Thứ Hai",
    2: "Thứ Ba",
    3: "Thứ Tư",
    4: "Thứ Năm",
    5: "Thứ Sáu",
    6: "Thứ Bảy",
}
UNKNOWN_DAY_PREFIX = "Ngày "
# Row order of the heat map, Monday first.
HEAT_ROW_ORDER = [1, 2, 3, 4, 5, 6, 0]

# Status and reason texts of an order trace.
STATUS_QUALIFIED = "Chấp nhận (Qualified)"
STATUS_EXCLUDED = "Loại bỏ (Excluded)"
REASON_QUALIFIED = "Đủ điều kiện (>= 2 món cốt lõi: %d món)"
REASON_G1 = "Nhóm 1: Đơn vốn chỉ có 1 món ban đầu (C_raw = 1)"
REASON_G2 = "Nhóm 2: Không có sản phẩm cốt lõi nào (toàn bộ là món hiếm)"
REASON_G3 = "Nhóm 3: Sau lọc chỉ còn 1 món cốt lõi (%s)"

# Names of the exclusion groups in the report.
GROUP_NAMES = {
    "G1": "Nhóm 1: Đơn vốn chỉ có 1 món ban đầu (C_raw = 1)",
    "G2": "Nhóm 2: Đơn rỗng sau khi lọc sản phẩm hiếm (C_raw >= 2, C_core = 0)",
    "G3": "Nhóm 3: Đơn chỉ còn 1 món sau khi lọc sản phẩm hiếm (C_raw >= 2, C_core = 1)",
}
# Own additions, so that the groups always add up to the excluded orders.
REASON_G0 = "Nhóm 0: Đơn không có dòng hàng (C_raw = 0)"
REASON_G4 = "Nhóm 4: Các món cốt lõi trùng một tên (%s)"
EXTRA_GROUP_NAMES = {
    "G0": "Nhóm 0: Đơn không có dòng hàng (C_raw = 0)",
    "G4": "Nhóm 4: Các món cốt lõi trùng một tên (C_core >= 2)",
}

# Default names of products missing from the catalog.
LOADER_DEFAULT_NAME = "Product_"
TRACE_DEFAULT_NAME = "Sản phẩm #"

# Label of a recommendation that no rule produced.
FALLBACK_LABEL = "[Fallback: Sản phẩm phổ biến toàn sàn]"

# The list shown in the selector when there is nothing else to offer.
DEFAULT_SELECTOR_ITEMS = ["Banana", "Bag of Organic Bananas", "Organic Strawberries", "Limes"]

# Thresholds.
MIN_ITEM_FREQ = 15000
SWEEP_MIN_ITEM_FREQ = 6000
MIN_BASKET_SIZE = 2
MIN_CONFIDENCE = 0.08
MIN_LIFT = 1.2
DEFAULT_MIN_SUPPORT = 0.00726
TOP_PRODUCTS = 15
POPULAR_REPORT_ITEMS = 10
RECOMMENDATIONS = 5
FALLBACK_ITEMS = 3
EVALUATION_KS = [3, 5, 10]
EVALUATION_SAMPLE = 1000
LIVE_CONFIG_PREFIX = "EXP-03*"

# The parameter sweep (configuration, minimum support, minimum confidence).
SWEEP_CONFIGS = [
    ("EXP-01", 0.010, 0.15),
    ("EXP-02", 0.008, 0.10),
    ("EXP-03* (Cấu hình chuẩn hệ thống)", 0.00726, 0.08),
    ("EXP-04", 0.005, 0.05),
    ("EXP-05", 0.003, 0.03),
]

# Timing marks of the execution log.
LOG_PATTERNS = {
    "spark_version": r"Running Spark version ([0-9.]+)",
    "init": r"SparkSession & JVM Context initialized in ([0-9.]+)s",
    "job0": r"Job 0 finished in ([0-9.]+)s",
    "job1": r"Job 1 finished in ([0-9.]+)s",
    "job2": r"Job 2 finished in ([0-9.]+)s",
    "job3": r"Job 3 finished in ([0-9.]+)s",
    "job4": r"Job 4 \(FPGrowth\.fit\) finished in ([0-9.]+)s",
    "step6": r"Step 6 completed in ([0-9.]+)s",
    "total": r"Total Pipeline Run Duration: ([0-9.]+) seconds",
}
OPTIONAL_MARKS = ["spark_version"]
