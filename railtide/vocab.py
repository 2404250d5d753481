"""Word lists, lookup tables, thresholds and patterns.

Everything in this module is data that decides results, so it must hold exactly
these values.  No logic lives here; every operator takes these as default
parameters, and callers may pass their own.
"""

# --------------------------------------------------------------------------
# Calendar and period labels
# --------------------------------------------------------------------------
MONTHS = {
    "jan": 1, "january": 1, "feb": 2, "february": 2, "mar": 3, "march": 3,
    "apr": 4, "april": 4, "may": 5, "jun": 6, "june": 6, "jul": 7, "july": 7,
    "aug": 8, "august": 8, "sep": 9, "sept": 9, "september": 9, "oct": 10,
    "october": 10, "nov": 11, "november": 11, "dec": 12, "december": 12,
}
FULL_MONTHS = [
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST",
    "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER",
]

# month and year in the name of a sheet
FILE_PERIOD = (
    r"(?i)(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|jun(?:e)?|jul(?:y)?|aug(?:ust)?"
    r"|sep(?:t|tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)[^0-9]*(20\d{2})"
)

AM_PEAK = "7-9am (AM PEAK)"
PM_PEAK = "5-7pm (PM PEAK)"
EARLY_OFF_PEAK = "5-7am (OFF PEAK)"
MIDDAY_OFF_PEAK = "9am-5pm (OFF PEAK)"
LATE_OFF_PEAK_10 = "7-10pm (OFF PEAK)"
LATE_OFF_PEAK_11 = "7-11pm (OFF PEAK)"
DAILY_TOTAL = "Daily Total"
PEAK_TOTAL = "Peak Total"
OFF_PEAK_TOTAL = "Off-Peak Total"
MONTHLY_TOTAL = "Monthly Total"

PERIOD_RANK = {
    DAILY_TOTAL: 0, AM_PEAK: 1, PM_PEAK: 2, EARLY_OFF_PEAK: 3, MIDDAY_OFF_PEAK: 4,
    LATE_OFF_PEAK_10: 5, LATE_OFF_PEAK_11: 6, PEAK_TOTAL: 20, OFF_PEAK_TOTAL: 21,
    MONTHLY_TOTAL: 22,
}
CLOCK_PERIOD_BASE = 100
UNKNOWN_PERIOD_RANK = 10000

# (label, every token that must occur), tried in this order
FUZZY_PERIODS = [
    (AM_PEAK, ("7-9am", "peak")),
    (PM_PEAK, ("5-7pm", "peak")),
    (EARLY_OFF_PEAK, ("5-7am", "off")),
    (MIDDAY_OFF_PEAK, ("9am-5pm", "off")),
    (LATE_OFF_PEAK_10, ("7-10pm", "off")),
    (LATE_OFF_PEAK_11, ("7-11pm", "off")),
    (DAILY_TOTAL, ("daily", "total")),
]

# (label, every spelling without white space)
EXACT_PERIODS = [
    (AM_PEAK, ("7-9am", "07:00-09:00", "0700-0900")),
    (PM_PEAK, ("5-7pm", "17:00-19:00", "1700-1900")),
    (EARLY_OFF_PEAK, ("5-7am", "05:00-07:00", "0500-0700")),
    (MIDDAY_OFF_PEAK, ("9am-5pm", "09:00-17:00", "0900-1700")),
    (LATE_OFF_PEAK_10, ("7-10pm", "19:00-22:00", "1900-2200")),
    (LATE_OFF_PEAK_11, ("7-11pm", "19:00-23:00", "1900-2300")),
    (PEAK_TOTAL, ("subtotal(peak)", "peaktotal")),
    (OFF_PEAK_TOTAL, ("subtotal(offpeak)", "offpeaktotal", "off-peaktotal")),
    (MONTHLY_TOTAL, ("total", "total(peak+offpeak)", "monthlytotal")),
]

STATION_ALIASES = {
    "betty_go": "betty_go_belmonte",
    "betty_go_belmonte": "betty_go_belmonte",
    "araneta_cubao": "araneta_center_cubao",
    "araneta_center_cubao": "araneta_center_cubao",
    "marikina": "marikina_pasig",
    "marikina_pasiq": "marikina_pasig",
    "marikina_pasig": "marikina_pasig",
    "total": "total",
}

# --------------------------------------------------------------------------
# Announcement vocabulary
# --------------------------------------------------------------------------
CLASS_SUSPENSION = [
    "no classes", "class suspension", "classes suspended", "suspended classes",
    "class suspended", "school suspension", "school closed", "university closed",
    "campus closed", "school closure", "class cancellation", "cancelled classes",
    "class postponement", "postponed classes", "resumption of classes",
    "classes will resume", "classes resume", "class resumption", "no classes and work",
    "no classes and office work", "asynchronous classes", "shift to online classes",
    "online classes", "flexible learning", "distance learning", "modular classes",
    "blended learning", "regular holiday", "special non-working holiday",
    "non-working holiday", "special working holiday", "school holiday",
    "academic holiday", "holiday break", "long weekend", "holiday tomorrow",
    "public holiday", "walang pasok", "walang klase", "walang pasok sa klase",
    "suspendido ang klase", "suspendido ang pasok", "kanselado ang klase",
    "suspensyon ng klase", "pagpapatuloy ng klase", "pampublikong pahinga",
    "espesyal na walang pasok", "regular na pahinga", "bukas ang pasok",
    "petsa ng pasok", "huling araw ng klase",
]

LGU_ADVISORY = [
    "no office transactions", "offices closed", "government offices closed",
    "suspension of work", "no work", "skeletal workforce", "work from home",
    "weather advisory", "storm signal", "signal number", "signal no.",
    "typhoon advisory", "tropical storm", "super typhoon", "monsoon", "habagat",
    "amihan", "bagyo", "baha", "flash flood", "flood advisory", "orange warning",
    "red warning", "yellow warning", "rainfall advisory", "heavy rain",
    "torrential rain", "estado ng kalamidad", "state of calamity", "calamity",
    "disaster", "force majeure", "road closure", "road closed",
    "partial road closure", "number coding", "expanded number coding",
    "coding scheme", "mmda hotline", "abiso sa mga motorista",
    "abiso mula sa mmda", "lto caravan", "theoretical driving course",
    "suspendido ang trabaho", "walang opisina", "walang trabaho",
    "sarado ang opisina", "advisory ng lgu",
]

TRANSPORT_DISRUPTION = [
    "tigil pasada", "transport strike", "jeepney strike", "drivers strike",
    "welga ng drivers", "welga ng jeep", "welga ng piston", "piston de marikina",
    "welga", "strike", "lrt-2 suspended", "lrt suspended", "lrt-2 suspension",
    "train suspended", "train suspension", "full suspension", "power failure",
    "service disruption", "train disruption", "lrt-2 disruption", "no lrt service",
    "lrt not operating", "lrt operations suspended", "provisionary service",
    "limited service", "partial suspension", "cubao-antipolo only",
    "antipolo-cubao only", "recto-santolan only", "suspendido ang operasyon",
    "tigil operasyon", "walang serbisyo ng lrt", "abisong lrt", "tigil ang lrt",
    "walang tren", "di tumatakbo ang lrt",
]

TRAIN_DEGRADATION = [
    "delayed train", "train delay", "lrt delay", "lrt-2 delay", "lrt delayed",
    "code yellow", "code yellow advisory", "degraded headway", "lrt-2 advisory",
    "lrt advisory", "train advisory", "service interruption", "gap in service",
    "extended headway", "delayed ang tren", "delayed ang lrt", "na-delay ang lrt",
]

ARENA_EVENT = [
    "concert", "sports event", "arena event", "major event", "smart araneta",
    "araneta coliseum", "big dome", "araneta", "philsports", "phil sports arena",
    "mall of asia arena", "moa arena", "festival mall arena", "filoil flying v",
    "filoil ecoil", "ust tiger dome", "jru", "game day", "uaap", "ncaa",
    "pba game", "fight night", "boxing event", "boxing match", "k-pop concert",
    "fans event",
]

ACADEMIC_CALENDAR = [
    "enrollment", "enrolment", "enrollment period", "registration period",
    "pre-enrollment", "online enrollment", "early registration", "orientation",
    "freshmen orientation", "new student orientation", "freshmen", "midterms",
    "midterm examination", "midterm exams", "finals", "final examination",
    "final exams", "board exam", "entrance exam", "examination", "exam",
    "exam week", "university exam week", "quiz bee", "graduation", "commencement",
    "moving up", "recognition day", "convocation", "academic calendar",
    "school calendar", "collegiate calendar", "university calendar",
    "semester starts", "semester begins", "start of classes",
    "first day of classes", "pasukan", "back to school", "intramurals",
    "sportsfest", "cheerdance", "university week", "foundation day", "college day",
    "js prom", "prom night", "schoolyear", "school year", "academic year",
    "sem break", "semester break", "christmas break", "summer break",
    "holiday break", "walang klase bukas", "huling araw ng klase", "paskuhan",
    "baccalaureate", "solemn investiture", "tiger hunt", "medical clearance",
    "onsite transactions", "office transactions", "evm", "remote learning",
    "advisory", "announcement", "notice",
]

ACADEMIC_EXTRA = [
    "schedule change", "class schedule", "school reopening", "holiday", "holidays",
]
LGU_EXTRA = ["holiday", "holidays", "long weekend"]
TRAFFIC = [
    "number coding", "coding scheme", "abiso sa mga motorista",
    "abiso mula sa mmda", "lto caravan", "theoretical driving course",
]
ACADEMIC_CONTEXT = [
    "class", "classes", "school", "university", "college", "campus", "student",
    "students", "academic", "faculty", "teacher", "professor", "pasok", "klase",
    "suspendido", "walang pasok", "enrollment", "exam", "graduation",
]

# keyword group -> friction weight
GROUP_FRICTION = {
    "full_suspension": 1.0, "transport_strike": 0.9, "partial_suspension": 0.85,
    "arena_event": 0.65, "train_degradation": 0.5,
}
FRICTION_GROUP_WORDS = {
    "full_suspension": ["full suspension", "power failure"],
    "transport_strike": ["transport strike", "tigil pasada"],
    "partial_suspension": ["partial suspension"],
    "arena_event": ["concert", "sports event"],
    "train_degradation": ["code yellow", "delayed train"],
}

# --------------------------------------------------------------------------
# Relevance filter
# --------------------------------------------------------------------------
CALENDAR_TITLES = [
    "academic calendar", "school calendar", "collegiate calendar",
    "university calendar",
]
CALENDAR_TITLE_ACTIONS = [
    "no classes", "suspended", "walang pasok", "holiday", "holiday break",
]
RELEVANT_STRONG = [
    "no classes", "class suspension", "classes suspended", "suspended classes",
    "class suspended", "school suspension", "school closed", "class cancellation",
    "class postponement", "cancelled classes", "resumption of classes",
    "regular holiday", "special non-working holiday", "non-working holiday",
    "school holiday", "academic holiday", "holiday break", "long weekend",
    "no office transactions", "no classes and office work", "no classes and work",
    "asynchronous classes", "shift to online classes", "classes will resume",
    "walang pasok", "walang klase", "walang pasok sa klase", "suspensyon ng klase",
    "kanselado ang klase", "suspendido ang klase", "suspendido ang pasok",
    "pampublikong pahinga", "estado ng kalamidad", "weather advisory",
    "storm signal", "signal number", "signal no.", "bagyo", "baha",
    "orange warning", "red warning", "habagat", "flash flood", "flood advisory",
    "state of calamity", "tigil pasada", "transport strike", "jeepney strike",
    "welga ng drivers", "welga ng jeep", "welga ng piston", "welga",
    "lrt-2 suspended", "lrt suspended", "lrt-2 suspension", "train suspended",
    "train suspension", "full suspension", "power failure", "service disruption",
    "train disruption", "lrt-2 disruption", "no lrt service",
    "provisionary service", "partial suspension", "cubao-antipolo only",
    "antipolo-cubao only", "suspendido ang operasyon", "tigil operasyon",
    "walang serbisyo ng lrt", "tigil ang lrt", "delayed train", "train delay",
    "lrt delay", "lrt-2 delay", "code yellow", "code yellow advisory",
    "degraded headway", "lrt-2 advisory", "lrt advisory", "service interruption",
    "delayed ang tren", "delayed ang lrt", "concert", "sports event",
    "arena event", "smart araneta", "araneta coliseum", "big dome", "araneta",
    "philsports", "moa arena", "uaap", "ncaa", "pba game",
]
RELEVANT_GENERAL = [
    "school", "university", "college", "academy", "campus", "student", "class",
    "classes", "pasok", "road", "weather", "typhoon", "bagyo", "signal", "storm",
    "flood", "baha", "lrt", "train", "strike", "concert", "event",
]
SUSPENSION_PATTERN = (
    r"(?iU)\b(suspend(?:ed|ion|ing)?|suspens(?:ion|yon|yo)?|suspenso|suspendido"
    r"|cancel(?:led|lation)?|postpone(?:d|ment)?|closure|closed|walang|tigil"
    r"|delayed?|disrupted?|strike|welga)\b"
)
SUSPENSION_CONTEXT = [
    "lrt", "mrt", "train", "rail", "line", "service", "station", "operations",
    "classes", "safety", "suspension of classes", "suspensiyon", "istasyon",
    "tren", "arena", "concert", "jeepney", "welga", "strike", "power", "cubao",
    "antipolo", "government", "lgu", "city",
]

# --------------------------------------------------------------------------
# Calendar-release filter
# --------------------------------------------------------------------------
CALENDAR_PRIMARY = [
    "academic calendar", "university calendar", "school calendar",
    "collegiate calendar",
]
CALENDAR_TIMEFRAME = [
    "a.y. 2026-2027", "ay 2026-2027", "a.y. 26-27", "s.y. 2026-2027",
    "sy 2026-2027", "2026-2027", "26-27", "a.y. 2026", "ay 2026", "s.y. 2026",
    "sy 2026",
]
CALENDAR_ACTION = [
    "released", "out now", "now available", "view", "download", "access",
    "check out", "here is", "here's", "announcing", "announced", "official",
    "updated", "revision",
]
CALENDAR_STRUCTURE = [
    "bit.ly", "tinyurl.com", "cutt.ly", ".edu", ".edu.ph", "drive.google.com",
    "docs.google.com",
]
CALENDAR_NEGATIVE = [
    "draft", "drafting", "proposed", "tentative", "subject to change",
    "preliminary",
]
CALENDAR_EXCLUDED_SOURCES = [
    "pagasa", "public information office", "pio", "government", "municipality",
]
CALENDAR_COLUMNS = [
    "id", "station", "source_name", "source_url", "scraped_at", "post_date",
    "event_date", "event_name", "category",
]
CALENDAR_MAX_AGE_DAYS = 30.0
CALENDAR_EXTRACTIONS_PER_PAGE = 6
CALENDAR_YEAR_LABEL = "A.Y. 2026-2027"

# school name -> acronym
ACRONYMS = {
    "polytechnic university of the philippines main": "PUP",
    "pup sentral na konseho ng mag-aaral": "PUP_SKM",
    "university of the east manila": "UE",
    "university of the east student council": "UE_USC",
    "far eastern university manila": "FEU",
    "feu central student organization": "FEU_CSO",
    "university of santo tomas": "UST",
    "ust central student council": "UST_CSC",
    "san beda university": "SBU",
    "san beda student council": "SBU_SC",
    "uerm memorial medical center": "UERM",
    "uerm medicine student council": "UERM_MSC",
    "st. paul university quezon city": "SPUQC",
    "st. paul university quezon city sao": "SPUQC_SAO",
    "stella maris college": "SMC",
    "technological institute of the philippines cubao": "TIP",
    "world citi colleges quezon city": "WCC",
    "ateneo de manila university": "ADMU",
    "ateneo sanggunian": "ADMU_SG",
    "university of the philippines diliman": "UPD",
    "up diliman university student council": "UPD_USC",
    "our lady of fatima university antipolo": "OLFU",
}

# --------------------------------------------------------------------------
# Branch filter
# --------------------------------------------------------------------------
BRANCH_SOURCE_TOKEN = "fatima"
BRANCH_SYSTEMWIDE = [
    "all campuses", "all olfu campuses", "all branches", "systemwide",
    "entire university", "across all campuses", "lahat ng campus",
]
BRANCH_EXCEPTION = (
    r"(?U)(?:except|excluding|maliban\s+sa|bukod\s+sa)\s+(?:(?:for|sa)\s+)?(?:olfu\s+)?antipolo"
)
BRANCH_TARGET = "antipolo"
# the calendar job's shorter variant
CALENDAR_BRANCH_SYSTEMWIDE = [
    "all campuses", "all olfu campuses", "all branches", "systemwide",
    "entire university",
]
CALENDAR_BRANCH_EXCEPTION = (
    r"(?U)(?:except|excluding|maliban\s+sa)\s+(?:(?:for|sa)\s+)?(?:olfu\s+)?antipolo"
)

# --------------------------------------------------------------------------
# Post URLs
# --------------------------------------------------------------------------
POST_HOST = "facebook.com"
BLOCKED_PATHS = [
    "/people/", "/profile.php", "/groups/", "/friends/", "/messages/",
    "/notifications/", "/login/", "/reel/", "/videos/", "/watch",
]
COMMENT_PARAMS = ["comment_id=", "reply_comment_id="]
PERMALINK_PATTERN = r"(?i)(/posts/|/permalink|story_fbid=|/photos/|fbid=|/share/(p|photo)/)"
IDENTITY_PARAMS = ["fbid", "story_fbid", "id"]
TRACKING_MARK = "?__cft__"
PHOTO_PAGE_MARK = "facebook.com/photo"

# --------------------------------------------------------------------------
# Text cleaning
# --------------------------------------------------------------------------
SYMBOL_CLASS = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
    r"\x{2702}-\x{27B0}\x{24C2}-\x{24E9}\x{1F100}-\x{1F251}\x{1F900}-\x{1F9FF}"
    r"\x{1FA00}-\x{1FA6F}\x{1FA70}-\x{1FAFF}\x{2600}-\x{26FF}\x{FE00}-\x{FE0F}"
    r"\x{200D}\x{2B50}\x{23F0}-\x{23FA}\x{203C}-\x{3299}]"
)
FOOTER_LINE = (
    r"(?iU)(#\w+|@\w+|www\.|https?://|\.edu\.ph|\.gov\.ph|\.com\.ph|\.facebook\."
    r"|f\s*[|/]\s*@|chooseSAN|#choose)"
)
BOILERPLATE = [
    r"(?idU)^.*?·\s*Shared with (?:Public|Friends)\s*",
    r"(?isU)All reactions:.*",
    r"(?isU)\b\d+\s+reactions?\b.*",
    r"(?isU)\b\d+\s+shares?\b.*",
]
EXPAND_TAIL = r"(?idU)\s*(?:See more|Tumingin pa|Read more)\s*[…\.]*$"
# every footer line holds one of these (lower case)
FOOTER_MARKS = ["#", "@", "www.", "http", ".ph", ".facebook.", "choosesan"]
LINE_TRIM_CHARS = " -_|•·"
MIN_LINE_CHARS = 3
PLACEHOLDER_CAPTION = "Official Advisory / Announcement (Infographic)"
TEXT_KEY_CHARS = 100
POST_TEXT_CHARS = 5000
IMAGE_TEXT_CHARS = 5000
EVENT_NAME_CHARS = 500
EVENT_DATE_CHARS = 100
NULL_WORDS = ["null", "none", "n/a", ""]
UNSPECIFIED_WORDS = ["n/a", "not specified", "null", "none"]

# --------------------------------------------------------------------------
# Categories and event codes
# --------------------------------------------------------------------------
CATEGORIES = ["academic", "lgu", "academic_calendar"]
CATEGORY_CODES = {"academic": "acad", "academic_calendar": "acad", "acad": "acad"}
CATEGORY_LABELS = {
    "academic": "Academic", "lgu": "LGU", "pagasa": "PAGASA",
    "academic_calendar": "Academic Calendar",
}
ACADEMIC_NAMES = [
    "university", "college", "school", "institute", "student council",
    "sanggunian", "student organization", "konseho", "mag-aaral", "feu", "ust",
    "ue", "pup", "uerm", "sbu", "tip", "wcc", "admu", "fatima",
]
LGU_NAMES = [
    "government", "pio", "public information", "municipality", "city government",
    "lgu",
]
REPAIR_LGU_NAMES = [
    "government", "pio", "public information", "municipality", "city of", "lgu",
]
REPAIR_TRAFFIC = ["number coding", "coding scheme", "caravan"]
REPAIR_TRAFFIC_CODE = "CIVIC_MAINTENANCE"
REPAIR_FALSE_CANCEL_CODES = [
    "CLASS_SUSPENSION", "ONLINE_CLASS_SHIFT", "EXAM_WEEK", "FRESHMEN_ORIENTATION",
]
REPAIR_LIFT_WORDS = ["resumed", "resume", "lifted", "called off", "cancelled"]
REPAIR_DEFAULT_NUMBER = 999999

# (code, words that raise it, words that veto it, priority: lowest wins)
EVENT_CODE_RULES = [
    ("CIVIC_MAINTENANCE", ["number coding", "coding scheme", "tree trimming",
                           "road clearance", "drainage declogging", "caravan",
                           "driving course"], [], 1),
    ("TRANSPORT_STRIKE", ["transport strike", "jeepney strike", "tigil pasada",
                          "transport disruption"], [], 2),
    ("RESUMPTION_CLASSES", ["resumption", "classes resume", "work resume",
                            "classes will resume"], [], 3),
    ("ONLINE_CLASS_SHIFT", ["online classes", "asynchronous", "remote learning",
                            "online synchronous"], [], 4),
    ("CLASS_SUSPENSION", ["walang pasok", "suspended classes", "classes suspended",
                          "class suspension", "campus closure", "suspended operations",
                          "school holiday", "non-working holiday"],
     ["korapsyon", "panawagan", "petition", "position paper"], 5),
    ("EXAM_WEEK", ["midterms", "finals", "departmental exam"],
     ["photoshoot", "application form"], 6),
    ("FRESHMEN_ORIENTATION", ["thomasian welcome", "freshmen week", "onboarding",
                              "orientation"], [], 7),
    ("WEATHER_ADVISORY", ["pagasa warning", "habagat", "monsoon", "typhoon",
                          "flooding"], [], 8),
]
CANCEL_WORDS = ["lifted", "called off", "cancelled", "resume", "resumption"]
# a suspension is only undone by words that end it; "cancelled" beside one announces it
SUSPENDING_CODES = ["CLASS_SUSPENSION"]
SUSPENSION_LIFT_WORDS = ["lifted", "called off", "resume", "resumption"]
CANCEL_TARGETS = {"RESUMPTION_CLASSES": "CLASS_SUSPENSION"}
NEVER_CANCELS = ["CIVIC_MAINTENANCE"]
NON_DISRUPTIVE_WORDS = [
    "petition", "position paper", "appeal for suspension", "panawagan",
    "korapsyon", "monitoring", "river park", "flood update",
]

# --------------------------------------------------------------------------
# Sweeps, budgets, freshness, weather
# --------------------------------------------------------------------------
# (mode, tier, limit per page, look-back in days)
SWEEPS = [
    ("strong", "lgu", 8, 1.0), ("strong", "major", 5, 1.0), ("strong", "quiet", 3, 1.0),
    ("medium", "lgu", 4, 0.333), ("medium", "major", 2, 0.333), ("medium", "quiet", 2, 0.333),
    ("light", "lgu", 2, 0.167), ("light", "major", 1, 0.167), ("light", "quiet", 1, 0.167),
    ("aggressive", "lgu", 8, 1.0), ("aggressive", "major", 5, 1.0), ("aggressive", "quiet", 3, 1.0),
]
DEFAULT_MODE = "medium"
DEFAULT_TIER = "quiet"
COST_PER_POST = 0.005
EXTRACTIONS_PER_PAGE = 25
PAST_EVENT_DAYS = 14
STALE_MINUTES = 45.0
LOCAL_OFFSET = "+08:00"
FORECAST_DAYS = 7
RAIN_RED_ABOVE = 30.0
RAIN_ORANGE_FROM = 15.0
RAIN_YELLOW_FROM = 7.5
BASELINE_WEATHER = {
    "temperature": 28.5, "humidity": 75.0, "rainfall_mm": 0.0, "wind_speed": 10.0,
}

# --------------------------------------------------------------------------
# Page diagnostics
# --------------------------------------------------------------------------
DIAGNOSTIC_KEYWORDS = [
    "no classes", "office work", "holiday", "university advisory",
    "class suspension", "walang pasok", "walang klase",
]
LOGIN_HINTS = [
    "log in", "login", "mag-log in", "mag-log", "gumamit ng ibang profile",
    "create new account", "gumawa ng bagong account", "checkpoint",
    "security check",
]

# --------------------------------------------------------------------------
# Workbook columns (sheet header -> table column, longest text)
# --------------------------------------------------------------------------
CAPACITY_TEXT = {"Station_Name": ("station_name", 128), "Platform_Design": ("platform_design", 128)}
CAPACITY_AREA = {"Directional_Usable_Area_m2": "directional_usable_area_m2"}
CAPACITY_COUNTS = {
    "Directional_Platform_Limit_Pax": "directional_platform_limit_pax",
    "Total_Concourse_Limit_Pax": "total_concourse_limit_pax",
    "Total_Station_Limit_Pax": "total_station_limit_pax",
}
INCIDENT_TEXT = {
    "Category": ("category", 256),
    "Specific Incident / Transgression": ("specific_incident_transgression", 256),
}
PROTOCOL_TEXT = {
    "APTA Standard Code": ("apta_standard_code", 128),
    "Official Document Title": ("official_document_title", 4096),
    "Scope & Relevance to Surge Management": ("scope_relevance_to_surge_management", 4096),
    "Strictly Human-Centric (Man-Protocol) Ground Tactics Justified": ("human_centric_ground_tactics", 4096),
    "Open-Access Link / Source": ("open_access_link_source", 4096),
}
FRICTION_TEXT = {
    "Trigger Category": ("trigger_category", 4096),
    "Specific Condition (API Input)": ("specific_condition_api_input", 4096),
    "NCR-Based Literature Source / Basis": ("ncr_literature_source_basis", 4096),
    "Open-Access Link": ("open_access_link", 4096),
}
FRICTION_WEIGHT = {"Friction Weight (0.0 to 1.0)": "friction_weight"}
FRICTION_FILES = {
    "academic": "FrictionIndex_Academic", "operational": "FrictionIndex_Operational",
    "pagasa": "FrictionIndex_PagASA",
}
