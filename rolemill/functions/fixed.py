"""Word lists, codes, limits and patterns that results depend on. Nothing here is computed."""

# --- fixed values: rank of a source when several carry one posting; 1 wins ---
SOURCE_RANK = {
    "adp": 1, "ashby": 1, "avature": 1, "bamboohr": 1, "beisen": 1, "beisen_legacy": 1, "breezy": 1, "cornerstone": 1,
    "darwinbox": 1, "dayforce": 1, "greenhouse": 1, "gupy": 1, "herp": 1, "hrmos": 1, "icims": 1, "jazzhr": 1, "join_com": 1,
    "jobvite": 1, "keka": 1, "lever": 1, "moka": 1, "oracle": 1, "pageup": 1, "paycom": 1, "paylocity": 1, "personio": 1,
    "phenom": 1, "pinpoint": 1, "recruitee": 1, "recruiterbox": 1, "rippling": 1, "smartrecruiters": 1, "softgarden": 1,
    "successfactors": 1, "taleo": 1, "teamtailor": 1, "ukg": 1, "workable": 1, "workday": 1,
    "amazon": 1, "apple": 1, "bytedance": 1, "google": 1, "meta": 1, "tesla": 1, "tiktok": 1, "uber": 1,
    "builtin": 2, "getonbrd": 2, "jobsch": 2, "manfred": 2, "programathor": 2, "remoteok": 2, "thehub": 2, "wanted": 2,
    "wellfound": 2, "weworkremotely": 2, "ycombinator": 2,
    "welcometothejungle": 3, "mercor": 3, "gem": 3,
    "seek": 4,
    "eightfold": 5,
    "bundesagentur": 6, "arbetsformedlingen": 6, "eures": 6, "jobbankca": 6, "usajobs": 6,
}
UNLISTED_RANK = 2
DIRECT_RANK = 1
GATED_SOURCES = ["welcometothejungle"]

# --- fixed values: employers that name no employer ---
PLACEHOLDER_EMPLOYERS = [
    "-", "--", ".", "...", "?", "n/a", "na", "n.a.", "none", "null", "not specified", "not disclosed", "not provided", "unspecified",
    "unknown", "undisclosed", "confidential", "confidentiel", "konfidentiell", "vertraulich", "anonymous", "anonyme", "anonym",
    "non renseigné", "non renseigne", "non précisé", "non precise", "no se especifica", "no especificado", "sin especificar",
    "siehe beschreibung", "see description", "see job description", "voir description", "ver descripción", "ver descripcion",
    "employer", "company", "empresa", "entreprise", "arbeitgeber", "private", "privat", "particulier",
]
HOSTNAME = r"^(?:www\.)?[a-z0-9][a-z0-9-]*(?:\.[a-z0-9-]+)+$"

# --- fixed values: pay above this, in dollars, is no pay for its period; units of a currency in a dollar; words of a period ---
PAY_CEILING = {"HOUR": 2000.0, "DAY": 10000.0, "WEEK": 50000.0, "MONTH": 200000.0, "YEAR": 5000000.0}
UNITS_PER_DOLLAR = {
    "AED": 3.67, "ARS": 1000.0, "BGN": 1.8, "BRL": 5.5, "CLP": 950.0, "CNY": 7.2, "COP": 4000.0, "CZK": 23.0, "DKK": 7.0,
    "EGP": 50.0, "HKD": 7.8, "HUF": 360.0, "IDR": 15000.0, "ILS": 3.7, "INR": 85.0, "ISK": 138.0, "JPY": 150.0, "KES": 130.0,
    "KRW": 1300.0, "MAD": 10.0, "MXN": 18.0, "MYR": 4.7, "NGN": 1500.0, "NOK": 11.0, "PEN": 3.8, "PHP": 58.0, "PLN": 4.0,
    "RON": 4.6, "RSD": 108.0, "SAR": 3.75, "SEK": 11.0, "THB": 35.0, "TRY": 40.0, "TWD": 32.0, "UAH": 41.0, "UYU": 40.0,
    "VND": 25000.0, "ZAR": 18.0,
}
PERIOD_WORDS = {
    "HOUR": r"(?i)(?:per\s+hour|hourly|/\s*hr\b|/\s*hour|\ban\s+hour\b)",
    "DAY": r"(?i)(?:per\s+day|daily|/\s*day|per\s+diem)",
    "WEEK": r"(?i)(?:per\s+week|weekly|/\s*week)",
    "MONTH": r"(?i)(?:per\s+month|monthly|/\s*month|\ba\s+month\b)",
    "YEAR": r"(?i)(?:per\s+year|per\s+annum|annually|annual|yearly|/\s*yr\b|/\s*year)",
}

# --- fixed values: names of countries; codes and names of states; towns that settle an ambiguous code ---
COUNTRY_NAMES = [
    ("DE", ["deutschland", "germany", "allemagne"]), ("FR", ["france", "frankreich"]),
    ("BE", ["belgique", "belgium", "belgien", "belgië"]), ("AT", ["österreich", "austria", "autriche"]),
    ("NL", ["nederland", "netherlands", "pays-bas", "niederlande"]), ("IT", ["italia", "italy", "italien"]),
    ("ES", ["españa", "spain", "espagne", "spanien"]), ("PT", ["portugal"]), ("PL", ["polska", "poland", "pologne", "polen"]),
    ("CH", ["schweiz", "suisse", "switzerland", "svizzera"]), ("LU", ["luxembourg", "luxemburg"]),
    ("DK", ["danmark", "denmark", "dänemark"]), ("SE", ["sverige", "sweden", "schweden"]), ("NO", ["norge", "norway", "norwegen"]),
    ("FI", ["suomi", "finland", "finnland"]), ("IE", ["ireland", "irlande", "irland"]), ("CZ", ["česko", "czech", "tschechien"]),
    ("US", ["united states", "u.s.a", "usa"]), ("GB", ["united kingdom", "england", "scotland", "wales", "uk", "u.k"]),
    ("CA", ["canada"]),
]
STATES = {
    "AL": "alabama", "AK": "alaska", "AZ": "arizona", "AR": "arkansas", "CA": "california", "CO": "colorado",
    "CT": "connecticut", "DE": "delaware", "FL": "florida", "GA": "georgia", "HI": "hawaii", "ID": "idaho", "IL": "illinois",
    "IN": "indiana", "IA": "iowa", "KS": "kansas", "KY": "kentucky", "LA": "louisiana", "ME": "maine", "MD": "maryland",
    "MA": "massachusetts", "MI": "michigan", "MN": "minnesota", "MS": "mississippi", "MO": "missouri", "MT": "montana",
    "NE": "nebraska", "NV": "nevada", "NH": "new hampshire", "NJ": "new jersey", "NM": "new mexico", "NY": "new york",
    "NC": "north carolina", "ND": "north dakota", "OH": "ohio", "OK": "oklahoma", "OR": "oregon", "PA": "pennsylvania",
    "RI": "rhode island", "SC": "south carolina", "SD": "south dakota", "TN": "tennessee", "TX": "texas", "UT": "utah",
    "VT": "vermont", "VA": "virginia", "WA": "washington", "WV": "west virginia", "WI": "wisconsin", "WY": "wyoming",
    "DC": "district of columbia", "PR": "puerto rico",
}
PROVINCES = ["AB", "BC", "MB", "NB", "NL", "NS", "NT", "NU", "ON", "PE", "QC", "SK", "YT"]
DELAWARE_TOWNS = [
    "bear", "bethany beach", "brookside", "camden", "christiana", "claymont", "clayton", "delmar", "dewey beach", "dover",
    "edgemoor", "elsmere", "felton", "frankford", "georgetown", "glasgow", "greenwood", "harrington", "hockessin", "laurel",
    "lewes", "middletown", "milford", "millsboro", "milton", "new castle", "newark", "ocean view", "pike creek",
    "rehoboth beach", "seaford", "selbyville", "smyrna", "townsend", "wilmington",
]
INDIAN_CITIES = [
    "agra", "ahmedabad", "amritsar", "bangalore", "bengaluru", "bhopal", "bhubaneswar", "chandigarh", "chennai", "cochin",
    "coimbatore", "dehradun", "delhi", "faridabad", "ghaziabad", "greater noida", "gurgaon", "gurugram", "guwahati",
    "hyderabad", "indore", "jaipur", "jodhpur", "kanpur", "kochi", "kolkata", "lucknow", "ludhiana", "madurai", "meerut",
    "mohali", "mumbai", "mysore", "mysuru", "nagpur", "nashik", "navi mumbai", "new delhi", "noida", "patna", "pune", "raipur",
    "rajkot", "ranchi", "surat", "thane", "thiruvananthapuram", "trivandrum", "vadodara", "vijayawada", "visakhapatnam",
]
INDONESIAN_CITIES = [
    "bali", "balikpapan", "bandung", "banjarmasin", "batam", "bekasi", "bogor", "central jakarta", "denpasar", "depok",
    "east jakarta", "jakarta", "jawa", "kalimantan", "kalimantan timur", "makassar", "malang", "medan", "north jakarta",
    "palembang", "pekanbaru", "samarinda", "semarang", "south jakarta", "south tangerang", "sulawesi", "sumatera", "surabaya",
    "tangerang", "west jakarta", "yogyakarta",
]
#: Names of states that are no evidence by themselves.
UNSAFE_STATE_NAMES = ["georgia", "virginia", "washington"]
US_COUNTRY = r"(?i)\b(?:united states(?: of america)?|u\.?s\.?a\.?)\b"
US_REMOTE = r"(?i)\b(?:remote|anywhere|nationwide)\b[\s,\-–—]*\(?\b(?:us|usa|u\.s\.)\b|\b(?:us|usa|u\.s\.)\b[\s,\-–—]*\b(?:remote|only|based|wide)\b"
OTHER_COUNTRIES = (
    "argentina|australia|austria|belgium|brazil|canada|chile|china|colombia|czech|denmark|egypt|england|finland|france|germany|"
    "greece|hungary|india|indonesia|ireland|israel|italy|japan|kenya|mexico|netherlands|new zealand|nigeria|norway|philippines|"
    "poland|portugal|romania|russia|scotland|singapore|south africa|spain|sweden|switzerland|thailand|turkey|ukraine|"
    "united kingdom|vietnam|wales"
)
PAY_RANGE = r"\$\s?[0-9][0-9,]{2,}(?:\.[0-9]{2})?\s*(?:-|–|—|to|and)\s*\$?\s?[0-9][0-9,]{2,}(?:\.[0-9]{2})?"
PAY_PHRASE = (
    r"(?i)(?:base (?:pay|salary)|salary range|pay range|compensation range|pay scale|hiring range|annual salary|hourly rate|"
    r"base compensation)[^.$]{0,80}\$\s?[0-9][0-9,]{2,}"
)

# --- fixed values: words of remote, hybrid and on-site work ---
REMOTE_TITLE_WORDS = ["remote", "anywhere", "work from home", "wfh", "telework"]
REMOTE_WORDS = [
    "remote", "anywhere", "work from home", "wfh", "telework", "telearbeit", "télétravail", "teletrabajo", "teletrabalho",
    "remoto", "フルリモート", "リモート", "在家办公", "远程",
]
HYBRID_WORDS = ["hybrid", "hybride", "hibrido", "híbrido", "ibrido", "ハイブリッド", "混合办公"]
ONSITE_WORDS = [
    "on-site", "on site", "onsite", "in-office", "in office", "vor ort", "presencial", "sur site", "prasenz", "präsenz", "出社",
    "现场",
]

# --- fixed values: ranks named by titles, in the order they are tried: level, pattern, what rules it out ---
SENIORITY = [
    ("INTERN", r"(?i)\b(intern|interns|internship|trainee|apprentice\w*|working student|werkstudent|praktikum|praktikant\w*|stagiaire|becari[oa]|co-?op student|placement student)\b", ""),
    ("EXECUTIVE", r"(?i)(\b(ceo|cto|cfo|coo|cio|ciso|cmo|cpo|chro|cro|cdo|cco)\b|\bchief\b|\b(vp|svp|evp|avp)\b|\bvice[- ]president\b|\bpresident\b|\bmanaging director\b)", r"(?i)\bchief of staff\b"),
    ("DIRECTOR", r"(?i)(\bdirectors?\b|\bhead of\b)", r"(?i)(\b(art|artistic|creative|casting|music|photography|funeral|athletic|choir|band|stage|film|video|technical) directors?\b|\bdirector of photography\b)"),
    ("MANAGER", r"(?i)\bmanagers?\b", r"(?i)\b(product|program|programme|project|account|community|brand|category|content|social media|customer success|partner|partnerships|case|property|fund|portfolio|asset|wealth|relationship|territory|traffic|inventory|contract|vendor|campaign|channel|product marketing|technical program|technical product) managers?\b"),
    ("PRINCIPAL", r"(?i)\bprincipals?\b", r"(?i)(\b(school|assistant|vice|deputy|associate) principal\b|\bprincipal (investigator|of|at)\b|\bprincipal'?s\b)"),
    ("STAFF", r"(?i)\bstaff\b.*\b(engineer|developer|scientist|designer|researcher|architect|programmer|technologist|sre)s?\b", ""),
    ("LEAD", r"(?i)\b(lead|leads)\b", r"(?i)\blead[- ]?(generation|gen|qualification|nurturing)\b"),
    ("SENIOR", r"(?i)(\bsenior\b|\bsr\.?\b|\bsnr\.?\b)", r"(?i)\bsenior (living|care|citizens?|center|centre|community|housing|services|advisor|advocate|companion|meals)\b"),
    ("MID", r"(?i)\b(mid[- ]level|intermediate)\b", ""),
    ("JUNIOR", r"(?i)(\bjunior\b|\bjr\.?\b|\bjnr\.?\b|\bentry[- ]level\b|\bnew grad(uate)?\b|\bgraduate\b)", r"(?i)(\bjunior (high|college|varsity|school)\b|\bgraduate (school|admissions|studies|program|programme)\b)"),
]

# --- fixed values: words of a kind of employment; the longest that occurs decides ---
EMPLOYMENT_WORDS = {
    "FULL_TIME": [
        "full-time", "full time", "fulltime", "permanent", "regular", "cdi", "temps plein", "vollzeit", "unbefristet",
        "jornada completa", "tiempo completo", "tempo integral", "efetivo", "heltid", "voltijd", "tempo pieno",
        "tempo indeterminato", "pelny etat", "pełny etat", "plny uvazek", "plný úvazek", "正社員", "新卒", "全职", "정규직",
    ],
    "PART_TIME": [
        "part-time", "part time", "parttime", "working student", "casual", "temps partiel", "teilzeit", "werkstudent", "aushilfe",
        "minijob", "media jornada", "tiempo parcial", "meio periodo", "meio período", "deltid", "deeltijd", "アルバイト", "パート",
        "兼职",
    ],
    "INTERN": [
        "internship", "intern", "apprentice", "trainee", "stage", "stagiaire", "alternance", "apprentissage", "praktikum",
        "praktikant", "ausbildung", "estagio", "estágio", "becario", "practicas", "prácticas", "aprendiz", "praktik", "stagiair",
        "tirocinio", "staz", "staż", "インターン", "实习", "實習", "인턴",
    ],
    "CONTRACT": [
        "contractor", "contract", "freelance", "consultant", "freier mitarbeiter", "autonomo", "autônomo", "契約社員", "業務委託",
        "合同", "外包", "계약직",
    ],
    "TEMPORARY": [
        "temporary", "temp", "seasonal", "fixed term", "fixed-term", "cdd", "interim", "intérim", "befristet", "temporal",
        "tempo determinato", "派遣",
    ],
}

# --- fixed values: parameters of an address that say where a reader came from, and fragments that are places on a page ---
TRACKING_PARAMETERS = {
    "gh_src", "gh_jid_src", "lever_source", "lever-source", "lever_via", "source", "src", "ref", "referrer", "referer", "fbclid",
    "gclid", "msclkid", "mc_cid", "mc_eid", "trk", "trackingid", "tracking_id", "recruiter", "iis", "iisn", "campaign", "medium",
}
TRACKING_PREFIX = "utm_"
PAGE_ANCHORS = {
    "", "apply", "apply-now", "applynow", "top", "main", "content", "header", "footer", "details", "job-details", "jobdetails",
    "description", "overview",
}

# --- fixed values: legal forms that end a company's name; keys that name no company; words of boards in a path ---
LEGAL_FORMS = [
    "inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "llc", "llp", "lp", "plc", "gmbh", "ag", "sa",
    "sas", "srl", "bv", "nv", "oy", "ab", "as", "kk", "pty", "holding", "holdings", "group",
]
STOP_KEYS = [
    "", "careers", "career", "jobs", "job", "corporate", "company", "inc", "llc", "ltd", "group", "holdings", "the", "test", "demo", "hr",
    "recruiting", "talent", "hiring", "external", "internal", "main", "home", "default", "new", "us", "usa", "global",
]
PATH_NOISE = [
    "external", "internal", "site", "sites", "career", "careers", "job", "jobs", "search", "professional", "experienced", "campus",
    "student", "students", "global", "us", "usa", "corporate", "main", "portal", "candidate", "candidates", "apply", "hiring", "talent",
    "recruiting", "general", "central", "east", "west", "north", "south", "domestic", "subsidiary", "new", "prod", "live", "tap",
    "gateway", "home", "default", "opportunities", "erp", "cx", "ext",
]

# --- fixed values: scripts that belong to one language ---
SCRIPTS = [
    ("ja", "[\u3040-\u309f\u30a0-\u30ff]"), ("ko", "[\uac00-\ud7af\u1100-\u11ff]"), ("th", "[\u0e00-\u0e7f]"), ("he", "[\u0590-\u05ff]"),
    ("ar", "[\u0600-\u06ff]"), ("el", "[\u0370-\u03ff]"), ("hi", "[\u0900-\u097f]"), ("zh", "[\u4e00-\u9fff]"),
]
#: Own choice: some of the commonest words of languages written in Latin letters, by which they are told apart.
COMMON_WORDS = {
    "de": ["der", "die", "und", "den", "das", "mit", "ist", "nicht", "ein", "für"],
    "en": ["the", "of", "and", "to", "is", "that", "for", "with", "was", "by"],
    "es": ["el", "los", "las", "por", "con", "una", "del", "para", "que", "y"],
    "fr": ["le", "les", "et", "des", "une", "est", "pour", "dans", "au", "qui"],
    "it": ["il", "di", "che", "per", "un", "non", "sono", "gli", "della", "e"],
    "nl": ["het", "een", "van", "en", "niet", "zijn", "voor", "op", "ook", "te"],
    "pl": ["w", "na", "się", "nie", "jest", "do", "że", "jak", "i", "z"],
    "pt": ["o", "os", "uma", "não", "com", "para", "do", "em", "mais", "as"],
    "sv": ["och", "att", "det", "som", "en", "är", "av", "inte", "med", "till"],
}

# --- fixed values: industries of funds, and business codes of sponsors that employ nobody ---
FUND_INDUSTRIES = ["Pooled Investment Fund", "Other Investment Fund", "Investing", "Commercial Banking"]
NO_EMPLOYER_CODES = ["813930", "813940", "525100", "525110", "525120", "525190", "525900", "524290"]

# --- fixed values: signs and codes of currencies, and the dollars of countries ---
CURRENCY_CODES = [
    "USD", "EUR", "GBP", "CAD", "AUD", "NZD", "CHF", "SEK", "NOK", "DKK", "PLN", "CZK", "HUF", "JPY", "CNY", "INR", "BRL", "MXN", "SGD",
    "HKD", "ZAR",
]
CURRENCY_SIGNS = [
    ("CA$", "CAD"), ("A$", "AUD"), ("NZ$", "NZD"), ("HK$", "HKD"), ("S$", "SGD"), ("R$", "BRL"), ("£", "GBP"), ("€", "EUR"), ("¥", "JPY"),
    ("₹", "INR"), ("zł", "PLN"),
]
DOLLARS = {"CA": "CAD", "AU": "AUD", "NZ": "NZD", "SG": "SGD", "HK": "HKD", "MX": "MXN"}

# --- fixed values: continents of the countries that country_of knows ---
CONTINENTS = {
    "Europe": ["DE", "FR", "BE", "AT", "NL", "IT", "ES", "PT", "PL", "CH", "LU", "DK", "SE", "NO", "FI", "IE", "CZ", "GB"],
    "North America": ["US", "CA"],
    "Asia": ["IN", "ID"],
}

# --- fixed values: locations that are no place; marks of legal text and of copy about a vacancy; kinds of organisations ---
PLACELESS = [
    "remote", "remote work", "fully remote", "100% remote", "work from home", "wfh", "anywhere", "anywhere in the world", "worldwide",
    "global", "globally", "international", "multiple locations", "various locations", "various", "flexible", "n/a", "na", "none", "tbd",
    "unspecified", "home office", "telearbeit", "teletrabajo", "télétravail", "remoto", "en remoto",
]
LEGALESE = (
    r"(?i)\b(?:equal\s+(?:opportunity|employment)\s+(?:employer|opportunity)|without\s+regard\s+to\s+race|regardless\s+of\s+race,"
    r"|protected\s+veterans?\s+status|reasonable\s+accommodations?\b|applicants?\s+(?:will|shall)\s+receive\s+consideration"
    r"|drug[\s-]free\s+workplace|e-verify|itar\b|export\s+(?:control|administration)\s+regulations"
    r"|u\.?s\.?\s+government\s+export\s+regulations|lawful\s+permanent\s+resident|recruit(?:ing|ment)\s+fraud"
    r"|background\s+(?:check|screening)\s+(?:is|will|may)|not\s+intended\s+to\s+be\s+all[\s-]inclusive"
    r"|pursuant\s+to\s+(?:the\s+)?(?:fair\s+chance|san\s+francisco|los\s+angeles)|\beeo\b|\bada\b\s+(?:compliance|accommodation)"
    r"|criminal\s+histor(?:y|ies)|401\s?\(?k\)?\s+(?:retirement|plan|match)|paid\s+time\s+off,|dental,?\s+vision)"
)
ROLE_OPENER = (
    r"(?i)^\s*(?:about\s+(?:the|this)\s+(?:role|position|job|opportunity|team)"
    r"|(?:the|this)\s+(?:role|position|job|opportunity|posting|listing)\s+(?:is|are|was|will|would|requires?|involves?|reports?|offers?"
    r"|has|have|may|can|entails?|includes?|focuses|sits|exists|of)\b|position\s+(?:summary|overview|title)"
    r"|job\s+(?:summary|description|title|type)|responsibilities\b|what\s+you(?:'|’)?ll\s+(?:do|be)"
    r"|we\s+are\s+(?:seeking|hiring|looking\s+for)\b|(?:compensation|salary|pay(?:\s+rate)?|hourly\s+rate|base\s+pay)\s*[:\-–]"
    r"|are\s+you\b|do\s+you\b)"
)
ORGANISATION_KINDS = ["organization", "corporation", "localbusiness", "ngo", "educationalorganization", "governmentorganization", "medicalorganization"]

# --- fixed values: hosts of boards, labels of career hosts, endings of two parts, hosts that say nothing of an employer ---
BOARD_HOSTS = [
    "job-boards.greenhouse.io", "boards.greenhouse.io", "jobs.ashbyhq.com", "jobs.lever.co", "apply.workable.com", "jobs.workable.com",
    "myworkdayjobs.com", "eightfold.ai", "jobs.personio.com", "jobs.personio.de", "recruitee.com", "teamtailor.com", "breezy.hr",
    "applytojob.com", "bamboohr.com", "smartrecruiters.com", "icims.com", "jobvite.com", "taleo.net", "successfactors.com",
    "oraclecloud.com", "avature.net", "phenompeople.com", "join.com", "pinpointhq.com", "rippling-ats.com", "gupy.io", "zhiye.com",
    "mokahr.com", "darwinbox.in", "dayforcehcm.com", "ultipro.com", "paylocity.com", "adp.com", "cornerstoneondemand.com",
    "pageuppeople.com", "jazz.co", "applicantpro.com", "gem.com", "csod.com", "recruiterbox.com", "hire.trakstar.com", "trakstar.com",
    "jobs.jobvite.com", "myworkdaysite.com", "wd1.myworkdayjobs.com", "eu.greenhouse.io", "jobs.eu.lever.co", "hrmdirect.com",
    "silkroad.com", "brassring.com", "peoplefluent.com", "clearcompany.com", "workforcenow.adp.com", "paycomonline.net", "paycor.com",
    "isolvedhire.com", "jobs.smartrecruiters.com", "ashbyhq.com", "greenhouse.io", "lever.co", "workable.com", "personio.com",
    "workday.com",
]
CAREER_LABELS = [
    "careers", "career", "jobs", "job", "apply", "applications", "opportunities", "opportunity", "recruiting", "recruitment", "hiring",
    "talent", "work", "join", "bewerben", "empleo", "emplois", "karriere", "candidate", "candidates", "search", "www",
]
TWO_PART_ENDINGS = [
    "co.uk", "org.uk", "ac.uk", "gov.uk", "co.jp", "co.nz", "co.za", "com.au", "com.br", "com.mx", "com.sg", "co.in", "com.cn",
]
NOISE_HOSTS = [
    "google.com", "www.google.com", "gstatic.com", "googleapis.com", "gravatar.com", "twitter.com", "x.com", "facebook.com",
    "instagram.com", "linkedin.com", "youtube.com", "github.com", "medium.com", "glassdoor.com", "indeed.com", "apple.com",
    "microsoft.com", "adobe.com", "cloudflare.com", "amazonaws.com", "cloudfront.net", "jsdelivr.net", "unpkg.com", "fontawesome.com",
    "bootstrapcdn.com", "typekit.net", "hotjar.com", "segment.com", "sentry.io", "intercom.com", "hubspot.com", "vimeo.com", "w3.org",
    "schema.org", "mozilla.org", "wikipedia.org", "tiktok.com", "threads.net", "bsky.app", "mailchimp.com", "calendly.com", "notion.so",
    "eeoc.gov", "dol.gov", "sec.gov", "ada.gov", "uscis.gov",
]
CAREERS_PATH = (
    r"(?i)(?:^|/)(?:careers?|jobs?|job-openings|open-roles|open-positions|opportunities|join-us|joinus|join-our-team|work-with-us"
    r"|work-for-us|work-here|employment|life-at-[\w-]+|why-[\w-]+)(?:/|$|[?#.])"
)
CAREERS_LABEL = (
    r"(?i)^\W*(?:careers?|jobs?|join\s+us|join\s+our\s+team|work\s+with\s+us|we(?:'|’)?re\s+hiring|open\s+roles|open\s+positions"
    r"|life\s+at\s+.{0,30}|view\s+(?:all\s+)?(?:jobs|openings))\W*$"
)

# --- letters and blanks as SQL engines see them, where Spark sees others ---
#: Letters without an upper case of one letter in the SQL engine's tables: they stay.
_STAY_UPPER = [
    0x149, 0x19B, 0x1F0, 0x264, 0x390, 0x3B0, 0x587, 0x1C8A, 0x1E96, 0x1E97, 0x1E98, 0x1E99, 0x1E9A, 0x1F50, 0x1F52, 0x1F54, 0x1F56,
    0x1FB2, 0x1FB4, 0x1FB6, 0x1FB7, 0x1FBC, 0x1FC2, 0x1FC4, 0x1FC6, 0x1FC7, 0x1FCC, 0x1FD2, 0x1FD3, 0x1FD6, 0x1FD7, 0x1FE2, 0x1FE3,
    0x1FE4, 0x1FE6, 0x1FE7, 0x1FF2, 0x1FF4, 0x1FF6, 0x1FF7, 0x1FFC, 0xA7CD, 0xA7DB, *range(0xFB00, 0xFB07), *range(0xFB13, 0xFB18),
    *range(0x10D70, 0x10D86),
]
#: Greek letters with an iota below, small and capital, eight of each.
_IOTA = [c for low in (0x1F80, 0x1F90, 0x1FA0) for c in range(low, low + 16)]
ONE_UPPER = {chr(c): chr(c) for c in _STAY_UPPER} | {chr(c): chr(c | 8) for c in _IOTA} | dict(zip("\u00df\u1fb3\u1fc3\u1ff3", "\u1e9e\u1fbc\u1fcc\u1ffc", strict=True))
ONE_LOWER = {chr(c): chr(c) for c in (0x1C89, 0xA7CB, 0xA7CC, 0xA7DA, 0xA7DC, *range(0x10D50, 0x10D66))} | {"\u0130": "i", "\u03a3": "\u03c3"}
#: What \s is there, and the blanks that its trim() takes.
SQL_BLANK = r"[ \t\n\f\r]"
SQL_ENDS = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
