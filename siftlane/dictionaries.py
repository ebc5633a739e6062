"""Word lists, weights and tables that rules and scores take as their defaults.

All of them are parameters of the operators that use them.
"""

#: Results depend on these words, their order and their numbers.

SCE_E1 = (
    "stenter", "stentor", "tenter", "tenter frame", "ram frame", "heat setting", "heat-setting", "thermofixation", "termo-fixação", "termofijado",
    "termofissaggio", "wärmefixierung", "brückner", "bruckner", "brueckner", "monforts", "montex", "monfortex", "krantz", "krantz stenter", "santex",
    "santex rimar", "artos", "artos textile", "babcock", "babcock-textil", "benninger", "benninger küsters", "goller", "goller group", "thies",
    "thies group", "chain rail", "rail chain", "pin chain", "clip chain", "stenter chain", "tenter pin", "stenter clip", "spindle nut", "slide block",
    "bearing bush",
)

SCE_E2 = (
    "dyeing", "printing", "finishing", "bleaching", "mercerizing", "sanforizing", "coating", "laminating", "calendering", "singeing", "desizing",
    "scouring", "shrink proofing", "dyehouse", "dye house", "finishing plant", "finishing line", "continuous dyeing", "jet dyeing", "pad dyeing",
    "terbiye", "boya", "boyama", "boyahane", "baskı", "apre", "ağartma", "merserizasyon", "sanfor", "kaplama", "laminasyon", "ram makinesi", "ramöz",
    "şardonlama", "zımparalama", "tinturaria", "tingimento", "acabamento", "estamparia", "alvejamento", "mercerização", "sanforização",
    "termofixação", "calandragem", "chamuscagem", "tintorería", "teñido", "acabados", "estampado", "blanqueo", "mercerizado", "sanforizado",
    "planta de acabado", "línea de acabado", "färberei", "druckerei", "ausrüstung", "veredlung", "bleicherei", "appretur", "kontinue-färbung",
    "tintoria", "stamperia", "finissaggio", "nobilitazione", "candeggio", "mercerizzazione",
)

SCE_E3 = (
    "textile manufacturing", "fabric manufacturing", "woven fabric", "knitted fabric", "knit fabric", "weaving mill", "knitting mill",
    "spinning mill", "textile mill", "textile plant", "textile factory", "tekstil üretimi", "kumaş üretimi", "dokuma fabrikası", "örme fabrikası",
    "iplik fabrikası", "tekstil fabrikası", "entegre tesis", "dikey entegrasyon", "tecelagem", "malharia", "fiação", "tecelaria", "fábrica têxtil",
    "indústria têxtil", "produção têxtil", "fabricação de tecidos", "tejeduría", "hilandería", "fábrica textil", "planta textil", "producción textil",
    "manufactura textil", "confección", "new line", "expansion", "investment", "capacity", "nova linha", "expansão", "investimento", "nueva línea",
    "expansión", "inversión", "modernization", "modernização", "modernización",
)

SCE_SUPPLIER = (
    "machinery", "equipment", "spare parts", "components", "máquina", "maquinaria", "repuestos", "partes", "máquinas", "equipamentos", "peças",
    "supplier", "dealer", "distributor", "agent", "trading", "import", "export company",
)

HEURISTIC_POSITIVE = (
    "stenter", "sanfor", "calender", "dyeing machine", "textile finishing", "finishing mill", "fabric finishing", "dye house", "dyeing plant",
    "spare parts", "wear parts", "chain", "clip", "pin plate", "needle bar", "estiradora", "sanforizado", "apresto", "tintorería", "acabado textil",
    "recambios", "repuestos", "cadena", "pinza", "maquinaria textil", "planta de acabado", "teñido", "rama", "sanforizadora", "acabamento textil",
    "tinturaria", "peças sobressalentes", "peças de reposição", "corrente", "clipe", "pinça", "beneficiamento textil", "ram makinesi", "kumaş boyama",
    "boyahane", "tekstil terbiye", "yedek parça", "kluppen", "iğne", "zincir", "kumaş apre", "spannrahmen", "textilveredlung", "färberei",
    "ersatzteile", "verschleißteile", "nadelkette", "gleitstein",
)

HEURISTIC_NEGATIVE = (
    "job", "career", "vacancy", "resume", "cv", "empleo", "vacante", "vaga", "kariyer", "iş ilanı", "stellenangebot", "news", "blog", "article",
    "haber", "noticias", "artigo", "forum", "university", "thesis", "academic", "student", "araştırma", "tez", "software", "consulting", "logistics",
    "shipping", "freight",
)

GATE_DOMAINS = (
    "alibaba.com", "aliexpress.com", "indiamart.com", "made-in-china.com", "globalsources.com", "ec21.com", "tradekey.com", "dhgate.com",
    "wikipedia.org", "youtube.com", "facebook.com", "linkedin.com", "twitter.com", "instagram.com", "pinterest.com", "reddit.com",
    "sciencedirect.com", "researchgate.net", "academia.edu", "textileworld.com", "fibre2fashion.com", "apparelresources.com",
)

GATE_GENERIC = (
    "manufacturer", "manufacturing", "textile", "textiles", "fabric", "fabrics", "finishing", "dyeing", "bleaching", "printing", "processing",
    "machine", "machinery", "equipment", "technology", "process", "industry", "industrial", "production", "products", "product", "stenter", "tenter",
    "ram", "stenters", "tenters", "frame", "frames", "unknown", "other", "various", "multiple", "general", "n/a", "na", "international",
    "traditional", "better", "deciphering", "science", "digital", "sons", "corporation", "company", "enterprise", "enterprises", "data",
)

GATE_MENU = (
    "about us", "about", "contact", "contact us", "home", "products", "services", "careers", "news", "blog", "faq", "privacy", "terms", "login",
    "register", "search", "menu", "main", "overview", "gallery", "team", "history",
)

GATE_COUNTRIES = (
    "chile", "brazil", "argentina", "peru", "colombia", "ecuador", "mexico", "turkey", "india", "pakistan", "bangladesh", "egypt", "morocco",
    "tunisia", "italy", "germany", "spain", "portugal", "france", "china", "vietnam",
)

GATE_OEM = (
    "brückner", "bruckner", "monforts", "krantz", "artos", "santex", "babcock", "goller", "dilmenler", "benninger", "ruckh", "santex rimar",
    "monforts textilmaschinen", "brückner textile", "brückner textil", "karl mayer", "karl mayer stoll", "stoll", "groz-beckert", "groz beckert",
    "demas", "demas textile machinery", "muratex", "muratex textile machinery", "lindauer dornier", "dornier", "tsudakoma", "toyota industries",
    "picanol", "itema", "rieter", "saurer", "trutzschler", "trützschler", "andritz", "andritz küsters", "küsters", "kusters", "mahlo",
    "erhardt+leimer", "erhardt leimer", "thies", "then", "fong", "fongs", "juki", "brother industries", "shima seiki", "uster technologies", "uster",
    "swegon", "bräcker", "elitex", "zinser",
)

GATE_MEDIA = (
    "texdata", "texdata international", "textileworld", "textile world", "fibre2fashion", "apparel resources", "just-style", "fashionunited",
    "textile magazine", "textile today", "textile focus", "textile excellence", "heimtextil", "techtextil", "itma", "itm istanbul", "texprocess",
    "domotex", "intertextile", "colombiatex", "febratex", "innovationintextiles", "innovation in textiles", "wtin",
    "world textile information network",
)

GATE_GARBAGE = (
    "what", "does", "how", "when", "where", "why", "who", "which", "upcoming", "new", "latest", "best", "top", "modern", "advanced", "using", "used",
    "uses", "about", "more", "less", "very", "much", "also", "even", "just", "only", "some", "any", "all", "each", "other", "such", "same",
    "different", "various", "several", "ckner", "nforts", "antz", "rtos", "ntex",
)

GATE_PARTS_SIGNALS = (
    "we have stock of", "spare parts stock", "largest stock of", "parts supplier", "machinery parts", "trading company", "import export", "reseller",
    "dealer",
)

GATE_HIGH_SOURCES = (
    "known_manufacturer", "association_member", "gots", "oekotex", "fair_exhibitor", "directory", "precision_search", "facility_verified",
)

GATE_MEDIUM_SOURCES = (
    "oem_customer", "brave_search", "fair",
)

COUNTRY_ALIASES = {
    "türkiye": "Turkey", "turkiye": "Turkey", "turkey": "Turkey", "brasil": "Brazil", "brazil": "Brazil", "brezilya": "Brazil", "mısır": "Egypt",
    "misir": "Egypt", "egypt": "Egypt", "fas": "Morocco", "morocco": "Morocco", "tunus": "Tunisia", "tunisia": "Tunisia", "hindistan": "India",
    "india": "India", "çin": "China", "china": "China", "pakistan": "Pakistan", "bangladeş": "Bangladesh", "bangladesh": "Bangladesh",
    "arjantin": "Argentina", "argentina": "Argentina", "peru": "Peru", "kolombiya": "Colombia", "colombia": "Colombia", "şili": "Chile",
    "chile": "Chile", "ekvador": "Ecuador", "ecuador": "Ecuador", "meksika": "Mexico", "mexico": "Mexico", "almanya": "Germany", "germany": "Germany",
    "italya": "Italy", "italy": "Italy", "portekiz": "Portugal", "portugal": "Portugal", "ispanya": "Spain", "spain": "Spain",
}

COMPANY_SUFFIXES = (
    "gmbh", "ag", "kg", "kgaa", "bv", "b.v.", "nv", "ltd", "limited", "llc", "inc", "corp", "co.", "company", "group", "s.a.", "s.l.", "s.p.a.",
    "spa", "sarl", "srl", "oy", "oyj", "as", "ab",
)

INDUSTRY_TERMS = (
    "textile", "spinning", "weaving", "knitting", "dyeing", "finishing", "mill", "mills", "fabrics", "garment", "denim",
)

EXTRACT_SHORT_SUFFIXES = (
    "as", "ab", "ag", "kg", "oy", "oyj", "nv",
)

EXTRACT_STOP_PHRASES = (
    "textile machinery", "dyeing and finishing", "spinning weaving dyeing", "spinning, weaving, dyeing", "textile industry",
    "textile machinery parts",
)

EXTRACT_STOP_ENTITIES = (
    "interspare", "elinmac", "itma", "citme", "singapore", "germany", "china", "asia", "europe",
)

EXTRACT_GENERIC = (
    "company", "companies", "unternehmen", "industry", "industrie", "textilindustrie", "textile industry", "textile machinery", "textile machines",
    "textilmaschinen", "maschinen", "machinery", "machines", "equipment", "stenter", "stenters", "finishing machines", "dyeing machines",
    "spare parts", "solutions", "products", "textilveredelungsanlagen", "neuanlagen", "mitarbeiter", "anlagen", "artos", "automatisierungstechnik",
    "lagerlogistik", "techniker", "stand", "messe", "expo", "exhibitor",
)

EXTRACT_ROLES = (
    "moderator", "bandleader", "manager", "director", "geschäftsführer", "ceo", "founder", "owner", "chairman",
)

SOURCE_PRIORITY = {
    "oekotex": 100, "gots": 100, "directory": 90, "better_cotton": 90, "wrap": 90, "known_manufacturer": 85, "precision_search": 80, "fair": 70,
    "oem_customer": 60, "brave_search": 50, "comtrade": 40,
}

NON_CUSTOMER = (
    "labels", "label", "labeling", "packaging", "etiket", "plastic", "plastics", "fiber industry", "synthetic fiber", "software", "consulting",
    "consultant", "erp", "mes", "machinery supplier", "machine supplier", "spare parts", "machinery dealer", "equipment dealer", "parts supplier",
    "university", "institute", "research center", "academy", "government", "ministry", "directorate", "council", "association", "federation",
    "chamber of commerce", "chamber", "board of trade", "trade body", "trade union", "magazine", "journal", "newsletter", "media group", "publishing",
    "news agency", "press agency", "tv channel", "television", "radio", "rug", "rugs", "carpet backing",
)

DOMAIN_BLOCKLIST = (
    "global-trace-base.org", "oeko-tex.com", "services.oeko-tex.com", "gots.org", "bettercotton.org", "wrap.org", "abit.org.br", "texbrasil.com.br",
    "febratex.com.br", "itmf.org", "instagram.com", "facebook.com", "linkedin.com", "youtube.com", "twitter.com", "indiamart.com", "alibaba.com",
    "made-in-china.com", "tradekey.com", "globalsources.com", "wikipedia.org", "emis.com", "dnb.com", "kompass.com", "europages.com", "zoominfo.com",
)

NAME_GENERIC = (
    "textile", "dyeing", "finishing", "knitting", "weaving", "fabric", "garment", "apparel", "clothing", "yarn", "cotton", "polyester", "denim",
    "jersey",
)

V10_TIER1 = (
    "brückner", "bruckner", "monforts", "krantz",
)

V10_TIER2 = (
    "artos", "santex", "babcock", "goller", "benninger", "thies",
)

V10_FINISHING = (
    "ramöz", "ramoz", "stenter", "boyahane", "terbiye", "apre", "boya tesisi", "boyama", "germe makinesi", "kurutma", "fikse", "finishing", "dyeing",
    "dyehouse", "mercerizing", "sanforizing", "calendering", "heat setting", "stentering", "textile mill", "tinturaria", "acabamento",
    "beneficiamento", "alvejamento", "tintorería", "acabado", "blanqueo", "teñido", "teinture", "finition", "blanchiment", "nhuộm", "hoàn tất", "sấy",
    "красильная", "отделка", "текстиль",
)

V10_NEGATIVE = (
    "machinery supplier", "machine manufacturer", "spare parts dealer", "spare parts supplier", "parts distributor", "machine dealer",
    "trading company", "textile machinery", "machinery trading", "maschinenhandel", "ersatzteilhandel", "makine üreticisi", "yedek parça satıcısı",
    "makine distribütörü",
)

ROLE_CUSTOMER = (
    "dyeing", "finishing", "bleaching", "printing", "coating", "sanforizing", "mercerizing", "stentering", "tentering", "wet processing",
    "fabric processing", "textile processing", "heat setting", "thermosetting", "shrinkage control", "boya", "terbiye", "apre", "baski", "kaplama",
    "yikama", "boyahane", "terbiyehane", "ram makinesi", "tinturaria", "acabamento", "beneficiamento", "estamparia", "alvejamento", "tecelagem",
    "malharia", "têxtil", "lavanderia industrial", "fábrica de tecidos", "indústria têxtil", "tintorería", "acabados", "tejeduría", "textil",
    "planta de acabado", "fábrica textil", "industria textil", "estampado", "blanqueo", "teñido", "mill", "dyehouse", "dye house", "finishing plant",
    "finishing house", "textile mill", "fabric mill", "cotton mill", "weaving mill", "processing plant", "production plant", "manufacturing plant",
    "fabrika", "tesisi", "üretim", "imalat", "dokuma", "örme", "denim", "cotton fabric", "polyester fabric", "knitted fabric", "woven fabric",
    "home textile", "technical textile", "workwear", "shirting", "suiting", "upholstery", "curtain", "towel", "stenter machine", "ram makine",
    "finishing range", "dyeing range", "jigger", "jet dyeing", "pad steam", "continuous dyeing",
)

ROLE_STRONG_CUSTOMER = (
    "integrated textile", "vertical integration", "spinning to finishing", "yarn to fabric", "weaving and finishing", "dyeing and finishing",
    "fabric manufacturer", "textile manufacturer", "fabric producer", "finishing capacity", "dyeing capacity", "production capacity",
    "oeko-tex certified", "gots certified", "iso certified", "export to europe", "supply to brands", "customer brands",
)

ROLE_INTERMEDIARY = (
    "dealer", "distributor", "trading", "trader", "importer", "exporter", "agent", "broker", "reseller", "wholesale", "retailer", "representante",
    "distribuição", "importadora", "exportadora", "revenda", "atacado", "varejo", "comércio", "distribuidor", "importador", "exportador",
    "revendedor", "mayorista", "minorista", "comercio", "spare parts", "spareparts", "yedek parça", "parts supplier", "machine parts",
    "replacement parts", "accessories", "peças de reposição", "repuestos", "machine sales", "machine dealer", "equipment dealer", "machinery trading",
    "selling machines", "buy machines", "máquinas", "equipamentos", "automação", "peças", "rolamentos", "correias", "venda de máquinas", "maquinas",
    "equipos", "automatización", "piezas", "rodamientos", "correas", "venta de máquinas", "botões", "etiquetas", "zíper", "aviamentos", "botones",
    "cremallera", "avíos", "news", "magazine", "journal", "publication", "media", "press release", "announcement", "article", "blog", "notícias",
    "revista", "noticias", "job", "career", "vacancy", "hiring", "recruitment", "employment", "emprego", "vaga", "contratação", "empleo", "vacante",
    "contratación", "marketplace", "b2b portal", "directory listing", "classifieds",
)

ROLE_STRONG_INTERMEDIARY = (
    "spare parts shop", "parts supplier", "machine trading company", "textile machinery dealer", "equipment trading", "machinery sales",
    "buy and sell", "import export trading", "trading house", "news portal", "industry magazine", "textile news", "moda", "fashion brand",
    "clothing brand", "moda feminina", "moda masculina", "moda infantil", "moda íntima", "moda praia", "moda festa", "moda fitness", "grife",
    "estilista",
)

ROLE_BRAND = (
    "moda", "fashion", "grife", "estilista", "designer", "collection", "coleção", "colección", "lookbook", "showroom", "boutique", "atelier",
    "ateliê", "ready to wear", "prêt-à-porter", "haute couture", "spring summer", "fall winter", "primavera verão",
)

ROLE_SOURCE_WEIGHTS = {
    "known_manufacturer": 1.0, "oem_customer": 0.9, "gots": 0.8, "oekotex": 0.8, "fair_exhibitor": 0.6, "facility_verified": 0.8, "directory": 0.5,
    "association_member": 0.6, "precision_search": 0.6, "brave_search": 0.3, "web_scrape": 0.2,
}

FAST_TRUSTED = (
    "gots", "oekotex", "bettercotton", "bluesign", "fair", "known_manufacturer", "egypt_tec", "amith", "abit", "association_member", "directory",
    "oem_customer", "precision_search", "regional_collector",
)

FAST_DOMAINS = (
    ".gov", ".edu", ".mil", "amazon.", "alibaba.", "aliexpress.", "ebay.", "facebook.", "linkedin.", "twitter.", "instagram.", "youtube.",
    "wikipedia.", "medium.", "news", "magazine", "journal", "press", "blog", "wordpress", ".blogspot.", "directory", "portal", "listing",
    "yellowpages", "government", "ministry", "university", "school",
)

FAST_PATHS = (
    "/members/", "/member-list/", "/directory/", "/listing/", "/category/", "/tag/", "/search/", "/news/", "/blog/", "/article/",
)

FAST_META = (
    "news portal", "magazine", "blog", "directory", "listing", "member list",
)

ENTITY_END_USER = (
    "dyeing", "textile mill", "fabric processing", "finishing", "knitting", "weaving", "spinning", "garment manufacturer", "fabric producer",
    "textile factory", "processing plant", "dyehouse", "print house", "textile processing", "terbiye", "boyahane", "örme", "dokuma", "iplik",
    "tintura", "teñido", "acabado", "tejeduría",
)

ENTITY_INTERMEDIARY = (
    "machinery", "equipment", "technology", "manufacturer", "machine seller", "stenter manufacturer", "textile machinery", "equipment supplier",
    "machine supplier", "brückner", "lafer", "monforts", "babcock", "benninger", "morrison", "santex", "ferraro", "goller", "krantz", "thies", "then",
    "mathis", "reggiani", "arioli",
)

ENTITY_BRAND = (
    "fashion", "apparel", "clothing", "garment brand", "retail", "design house", "collection", "boutique", "clothing brand", "fashion house",
)

ENTITY_ASSOCIATION = (
    "association", "chamber", "council", "federation", "institute", "society", "union", "syndicate", "dernek", "birlik", "oda", "kurum",
)

QUALIFY_MACHINERY = (
    "stenter", "tenter", "ram", "ramöz", "spannrahmen", "montex", "power-frame", "power frame", "heat setting", "heat-setting", "thermofixierung",
)

QUALIFY_OPERATIONS = (
    "finishing", "terbiye", "acabado", "finissage", "finition", "dyeing", "boyama", "teñido", "teinture", "tingimento", "bleaching", "ağartma",
    "blanqueo", "mercerizing", "merserize", "heat setting", "thermofixierung", "termofiksaj", "coating", "kaplama", "beschichtung", "sanforizing",
    "sanfor", "drying", "kurutma", "secado",
)

QUALIFY_OEM_BRANDS = (
    "brückner", "bruckner", "brueckner", "monforts", "montex", "krantz", "artos", "santex", "babcock", "strahm",
)

QUALIFY_PRODUCT_CATEGORIES = (
    "woven fabric", "knitted fabric", "dokuma", "örme", "denim", "nonwoven", "technical textile", "home textile", "ev tekstili", "upholstery",
    "döşemelik", "automotive textile", "otomotiv tekstil",
)

QUALIFY_NOT = (
    "spinning only", "sadece iplik", "yarn manufacturer", "garment only", "sadece konfeksiyon", "apparel manufacturer", "clothing factory",
    "giyim fabrikası", "machinery manufacturer", "makine üreticisi", "textile machinery", "tekstil makinesi", "distributor", "trading company",
    "ticaret şirketi",
)

QUALIFY_SOURCES = (
    "known_manufacturer", "oem_customer", "precision_search",
)

QUALIFY_COUNTRIES = (
    "turkey", "türkiye", "egypt", "brazil", "argentina", "pakistan", "india",
)

MAIL_GENERIC = (
    "noreply", "no-reply", "donotreply", "mailer",
)

MAIL_INFO = (
    "info", "contact", "hello", "enquiry", "inquiry",
)

MAIL_DEPARTMENT = (
    "sales", "export", "support", "marketing", "purchase", "procurement",
)

SIGNAL_FINISHING = (
    "textile finishing", "finishing mill", "fabric finishing", "dyehouse", "dyeing plant", "dyeing", "bleaching", "printing", "acabado textil",
    "tintoreria", "tenido", "planta de acabado", "acabamento textil", "tinturaria", "beneficiamento textil", "textilveredelung", "faerberei",
    "ausruestung", "appretur", "tekstil terbiye", "boyahane", "kumas boyama", "apre",
)

SIGNAL_STENTER = (
    "stenter", "tenter frame", "sanfor", "calender", "rama", "estiradora", "sanforizado", "sanforizadora", "spannrahmen", "kalandrier",
    "ram makinesi", "ram", "kalandir",
)

SIGNAL_PARTS = (
    "spare parts", "wear parts", "chain", "clip", "pin plate", "needle bar", "repuestos", "recambios", "cadena", "pinza", "placa de agujas",
    "pecas de reposicao", "pecas sobressalentes", "corrente", "clipe", "pinca", "ersatzteile", "verschleissteile", "kette", "kluppen", "nadelkette",
    "gleitstein", "yedek parca", "zincir", "igne", "igne zinciri",
)

SIGNAL_FACILITY = (
    "plant", "factory", "mill", "production", "facility", "capacity", "planta", "fabrica", "capacidad", "produccion", "capacidade", "producao",
    "werk", "fabrik", "produktion", "kapazitat", "fabrika", "tesis", "kapasite", "uretim",
)

SIGNAL_WEIGHTS = {"finishing": 3, "stenter": 4, "parts": 3, "facility": 1}

SIGNAL_NEGATIVE = (
    "job", "career", "vacancy", "cv", "news", "blog", "university", "student", "academy",
)
