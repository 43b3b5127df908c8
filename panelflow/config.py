"""Default settings: feature lists, lexicons, limits.

All of these are fixed values that downstream results depend on, stated as plain text.
"""

from __future__ import annotations

TARGET = "inflation_rate_t_plus_1"

NUMERIC_FEATURES = [
    "inflation_lag_1",
    "inflation_lag_3",
    "inflation_lag_6",
    "inflation_lag_12",
    "rolling_mean_3",
    "rolling_mean_6",
    "rolling_mean_12",
    "rolling_std_6",
    "gdp_growth",
    "interest_rate",
    "month_sin",
    "month_cos",
]

KEYWORD_CATEGORIES = [
    "inflation",
    "crisis",
    "growth",
    "interest",
    "unemployment",
    "gdp",
    "currency",
    "market",
]

TEXT_FEATURES = [
    "text_sentiment_score",
    "text_tfidf_mean",
    "text_vocabulary_richness",
    *[f"text_keyword_{c}" for c in KEYWORD_CATEGORIES],
    "text_article_count",
]

# Economic keywords per category (English and Spanish).
ECONOMIC_KEYWORDS = {
    "inflation": ["inflation", "inflacion", "inflación"],
    "crisis": ["crisis", "recession", "recesion", "recesión", "crash", "colapso"],
    "growth": ["growth", "crecimiento", "expansion", "expansión", "boom"],
    "interest": ["interest rate", "tasa de interes", "tasa de interés", "fed", "bce", "bcp"],
    "unemployment": ["unemployment", "desempleo", "paro", "jobs", "empleo"],
    "gdp": ["gdp", "pib", "producto interno", "gross domestic"],
    "currency": ["currency", "moneda", "dollar", "dolar", "dólar", "euro", "sol", "peso"],
    "market": ["market", "mercado", "stock", "bolsa", "bourse", "indices", "indice"],
}

# Sentiment word lists (English and Spanish).
POSITIVE_WORDS = [
    "growth", "expansion", "boom", "recovery", "strong", "positive", "gain", "rise",
    "crecimiento", "expansión", "recuperación", "fuerte", "positivo", "ganancia", "aumento",
    "optimistic", "optimista", "bullish", "confident", "confianza",
]
NEGATIVE_WORDS = [
    "crisis", "recession", "recesión", "crash", "collapse", "weak", "negative", "loss", "fall",
    "colapso", "débil", "negativo", "pérdida", "caída", "decline", "decrease",
    "pessimistic", "pesimista", "bearish", "fear", "miedo", "panic", "pánico",
    "inflation", "inflación", "stagflation", "hyperinflation", "hiperinflación",
]

# Crawl and corpus limits.
MAX_ENTRIES_PER_FEED = 10
MAX_ARTICLES = 50
MAX_AGE_DAYS = 30
MIN_PRIMARY_ROWS = 10
MAX_FALLBACK_ROWS = 5
MIN_TEXT_CHARS = 100
MIN_TOKENS = 10
MIN_TFIDF_TOKENS = 20
MAX_TERMS = 1000
MAX_DOCUMENT_SHARE = 0.95

# Uploads.
REQUIRED_UPLOAD_COLUMNS = ["date", "inflation_rate"]
ID_COLUMNS = ["country_code", "country_name"]
ALLOWED_UPLOAD_COLUMNS = [
    *REQUIRED_UPLOAD_COLUMNS,
    "gdp_growth",
    "interest_rate",
    *[f for f in NUMERIC_FEATURES if f not in ("gdp_growth", "interest_rate")],
    *TEXT_FEATURES,
]


def default_config() -> dict:
    """Training configuration; callers copy and change what they need."""
    return {
        "target": TARGET,
        "features": {"numeric": list(NUMERIC_FEATURES), "text": list(TEXT_FEATURES)},
        "preprocessing": {
            "numeric": {"imputer_strategy": "median", "scaler": "standard"},
            "text": {"imputer_strategy": "constant", "imputer_fill_value": 0},
        },
        "model": {
            "algorithm": "xgboost",
            "random_state": 42,
            "hyperparameters": {
                "n_estimators": 200,
                "max_depth": 6,
                "learning_rate": 0.1,
                "subsample": 0.8,
                "colsample_bytree": 0.8,
            },
        },
        "split": {"method": "temporal", "test_months": 12, "validation_months": 6},
        "versioning": {
            "model_version": "v1.0.0",
            "experiment_name": "inflation_forecast",
        },
    }

# The English and Spanish stop words of Spark ML's StopWordsRemover.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()
SPANISH_STOP_WORDS = """
de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí
porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante todos
uno les ni contra otros ese eso ante ellos e esto mí antes algunos qué unos yo otro otras otra él
tanto esa estos mucho quienes nada muchos cual poco ella estar estas algunas algo nosotros mi mis tú
te ti tu tus ellas nosotras vosostros vosostras os mío mía míos mías tuyo tuya tuyos tuyas suyo suya
suyos suyas nuestro nuestra nuestros nuestras vuestro vuestra vuestros vuestras esos esas estoy
estás está estamos estáis están esté estés estemos estéis estén estaré estarás estará estaremos
estaréis estarán estaría estarías estaríamos estaríais estarían estaba estabas estábamos estabais
estaban estuve estuviste estuvo estuvimos estuvisteis estuvieron estuviera estuvieras estuviéramos
estuvierais estuvieran estuviese estuvieses estuviésemos estuvieseis estuviesen estando estado
estada estados estadas estad he has ha hemos habéis han haya hayas hayamos hayáis hayan habré habrás
habrá habremos habréis habrán habría habrías habríamos habríais habrían había habías habíamos
habíais habían hube hubiste hubo hubimos hubisteis hubieron hubiera hubieras hubiéramos hubierais
hubieran hubiese hubieses hubiésemos hubieseis hubiesen habiendo habido habida habidos habidas soy
eres es somos sois son sea seas seamos seáis sean seré serás será seremos seréis serán sería serías
seríamos seríais serían era eras éramos erais eran fui fuiste fue fuimos fuisteis fueron fuera
fueras fuéramos fuerais fueran fuese fueses fuésemos fueseis fuesen sintiendo sentido sentida
sentidos sentidas siente sentid tengo tienes tiene tenemos tenéis tienen tenga tengas tengamos
tengáis tengan tendré tendrás tendrá tendremos tendréis tendrán tendría tendrías tendríamos
tendríais tendrían tenía tenías teníamos teníais tenían tuve tuviste tuvo tuvimos tuvisteis tuvieron
tuviera tuvieras tuviéramos tuvierais tuvieran tuviese tuvieses tuviésemos tuvieseis tuviesen
teniendo tenido tenida tenidos tenidas tened
""".split()
