"""Words of the public interface: names of classes, bands, actions and report columns."""

# The label column, the identifier column, the label map and the class names.
LABEL_COLUMN = "diagnosis"
ID_COLUMN = "id"
LABEL_MAP = {"M": 1, "B": 0}
CLASS_NAMES = ("Benigno", "Maligno")
TARGET_NAME = "target"

# The ten measurements, the three statistics, and the prefixes that cannot be zero.
MEASUREMENTS = (
    "radius", "texture", "perimeter", "area", "smoothness",
    "compactness", "concavity", "concave_points", "symmetry", "fractal_dimension",
)
STATISTICS = ("mean", "se", "worst")
NEVER_ZERO_PREFIXES = ("radius", "perimeter", "area", "texture")

# How a feature suffix reads in a figure label.
SUFFIX_LABELS = {"_mean": "media", "_se": "erro-padrao", "_worst": "pior"}

# Split names, sizes, folds, seeds and the required recall.
SPLIT_NAMES = {"train": "treino", "val": "validacao", "test": "teste"}
TEST_SHARE = 0.20
VALIDATION_SHARE = 0.20
FOLDS = 5
SEED = 42
TARGET_RECALL = 0.99
DEFAULT_THRESHOLD = 0.50
HIGH_RISK = 0.90

# Bands, suggestions, actions and error types.
BANDS = {"red": "vermelho", "amber": "amarelo", "green": "verde"}
SUGGESTION_POSITIVE = "SUSPEITO"
SUGGESTION_NEGATIVE = "sem sinais"
ACTIONS = {
    "VERMELHO": "Encaminhamento imediato ao mastologista",
    "AMARELO": "Revisao humana prioritaria (zona de incerteza)",
    "VERDE": "Seguir fila de rotina",
}
ERROR_MISSED = "FALSO NEGATIVO"
ERROR_ALARM = "falso positivo"
CASE_NAMES = ("falso_negativo", "falso_positivo", "verdadeiro_positivo", "caso_ambiguo")


def feature_columns() -> list[str]:
    """The thirty feature names: every measurement for the first statistic, then the next."""
    return [f"{m}_{s}" for s in STATISTICS for m in MEASUREMENTS]
