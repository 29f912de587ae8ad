"""Column names of the work-order data model and the window order."""

from __future__ import annotations

from pyspark.sql import types as T

# The export's original column headers and the engine names they map to.
RAW_TO_ENGINE = {
    "Data fine": "end_date_raw",
    "Ora fine": "end_time_raw",
    "WO": "wo",
    "FASE": "phase",
    "ARTICOLO": "article",
    "Descrizione Articolo": "article_desc",
    "ID DAD": "dad_id",
    "Descrizione Macchina": "machine",
    "C.d.L. Prev": "work_center_planned",
    "Descrizione Centro di Lavoro previsto": "work_center_desc",
    "C.d.L. Effett": "work_center_actual",
    "Cod CIC": "cic_code",
    "Tempo Attrezz. ORE": "setup_hours",
    "Tempo Lavoraz. ORE": "work_hours",
    "Durata Soste Ore": "stop_hours",
    "Buon Tempo Ciclo MIN.": "cycle_minutes",
    "Tempo Macc AS400 ORE": "erp_machine_hours",
    "Tempo Attr AS400 ORE": "erp_setup_hours",
    "Tot pezzi Contegg.": "pieces_counted",
    "Qta totale su AS/400": "qty_erp",
    "Pezzi da Avanzare": "pieces_to_advance",
    "Scarti Materiale": "scrap_material",
    "Scarti Lavoraz.": "scrap_machining",
    "Pezzi Ripassati": "pieces_reworked",
    "Data_Ora_Fine": "end_ts",
    "Buon Tempo Ciclo ORE": "cycle_hours",
    "Tempo_Teorico_TOT_ORE": "theoretical_hours",
    "Indice_Inefficienza": "inefficiency",
}

# decimal-comma text columns of the raw export (hours, or minutes per piece)
DECIMAL_COMMA_COLS = ["setup_hours", "work_hours", "stop_hours", "cycle_minutes",
                      "erp_machine_hours", "erp_setup_hours"]
INTEGER_COLS = ["pieces_counted", "qty_erp", "pieces_to_advance",
                "scrap_material", "scrap_machining", "pieces_reworked"]

# categorical columns normalised before scoring
CATEGORICAL_COLS = ["article_group", "phase", "cic_code", "work_center_planned", "work_center_desc"]

# total order of rows inside a machine
ORDER_COLS = ["end_ts", "wo", "phase", "l_partkey", "l_suppkey"]
PARTITION_COLS = ["machine"]
ROW_KEY = ["wo", "phase", "l_partkey", "l_suppkey", "end_ts"]

CLEAN_SCHEMA = T.StructType([
    T.StructField("wo", T.LongType()),
    T.StructField("phase", T.StringType()),
    T.StructField("article", T.StringType()),
    T.StructField("machine", T.StringType()),
    T.StructField("work_center_planned", T.StringType()),
    T.StructField("cic_code", T.StringType()),
    T.StructField("end_ts", T.TimestampNTZType()),
    T.StructField("pieces_counted", T.LongType()),
    T.StructField("qty_erp", T.LongType()),
    T.StructField("pieces_to_advance", T.LongType()),
    T.StructField("setup_hours", T.DoubleType()),
    T.StructField("work_hours", T.DoubleType()),
    T.StructField("stop_hours", T.DoubleType()),
    T.StructField("cycle_hours", T.DoubleType()),
    T.StructField("erp_machine_hours", T.DoubleType()),
    T.StructField("erp_setup_hours", T.DoubleType()),
    T.StructField("scrap_material", T.LongType()),
    T.StructField("scrap_machining", T.LongType()),
    T.StructField("pieces_reworked", T.LongType()),
    T.StructField("theoretical_hours", T.DoubleType()),
    T.StructField("inefficiency", T.DoubleType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()),
])

# OEE class labels and edges, anomaly state labels.
OEE_ACCEPTABLE = 0.65
OEE_OPTIMAL = 0.85
OEE_CLASSES = ["Critico", "Accettabile", "Ottimo"]
STATE_LABELS = ["NORMALE", "ATTENZIONE", "ANOMALIA"]
BINARY_LABELS = ["NORMALE", "ANOMALIA"]
OTHER_ARTICLE = "ALTRO"
MISSING = "MISSING"
MISSING_ARTICLE = "MISSING_ARTICOLO"
DEFAULT_ATTENTION_CUT = 1.1511
DEFAULT_ANOMALY_CUT = 1.4220
DEFAULT_PROBA_CUT = 0.30
