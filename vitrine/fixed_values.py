"""Values that decide results and therefore must stay exactly as they are.

Everything in this module is a fixed value: text formats, patterns, labels and
column lists that stored tables and reports depend on.
"""

# --- fixed values: text formats and patterns of a raw listing (Java regex) ---
SCRAPE_FORMAT = "yyyy-MM-dd HH:mm"
SCRAPE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}$"
INSTALMENT_COUNT = r"(\d+)x"
INSTALMENT_VALUE = r"R\$ (\d+,\d{2})"
PERCENT_TEXT = r"^\d+%$"
PRICE_TEXT = r"^R\$?\s?\d{1,3}(\.\d{3})*(,\d{2})?$"
CURRENCY_MARK = "R$"
# Unicode digits and blanks, plus the four separator controls that \s leaves out.
MEMORY_SIZE = r"(?iU)\d+[\s\x1c-\x1f]*GB"
OLED_NAME = "(?i)oled"
LINK_HOST = r"^(.*?\.com)"

# --- fixed values: fields of a keyed message, in order ---
MESSAGE_FIELDS = ["codigo", "nome", "preco", "desconto", "parcelamento", "link", "origem", "extract"]

# --- fixed values: labels ---
NO_MEMORY = "-"
OLED_YES = "Sim"
OLED_NO = "Nao"
ADVICE_INSTALMENTS = "Comprar Parcelado"
ADVICE_CASH = "Comprar a Vista Pix"
ADVICE_NONE = "Sem Vantagem Identificada"

# --- fixed values: landing folders ---
FOLDER_FORMAT = "yyyy-MM-dd_HH"
# A flush waits for this many rows or this time, whichever comes first.
FLUSH_ROWS = 2000
FLUSH_SECONDS = 60
FLUSH_EVERY = "1 minute"

# --- fixed values: windowed consumer ---
WINDOW_SECONDS = 5
TOLERANCE_SECONDS = 5
LATENESS = "5 seconds"

# --- fixed values: keys ---
STREAM_DEDUP_KEYS = ["codigo", "preco", "desconto", "parcelamento"]
BATCH_DEDUP_KEYS = ["codigo", "nome", "preco", "desconto", "parcelamento"]
CLUSTER_KEYS = ["codigo", "extract"]

# --- fixed values: operational reports ---
RUN_OK = "SUCCEEDED"
RUN_FAILURES = ["ERROR", "FAILED", "SKIPPED"]
RUN_TIMEOUT = "TIMED_OUT"
JOB_CLUSTER_PREFIX = "job"
LINEAGE_READ = "leitura"
LINEAGE_WRITE = "escrita"
