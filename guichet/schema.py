"""Ticket, document and prediction schemas, and the fixed label domains."""

from __future__ import annotations

# Column order, label domains and spellings of the ticket data.
TICKET_COLUMNS = [
    "ID", "texte", "titre", "categorie", "urgence", "temps_resolution", "type_ticket", "nb_mots",
]
BALANCED_COLUMNS = TICKET_COLUMNS + ["text_full"]
URGENCY_LABELS = ["Basse", "Moyenne", "Haute"]
URGENCY_ALIASES = {"Très haute": "Haute"}
TYPE_LABELS = ["Demande", "Incident"]
SPLIT_LABELS = ["train", "validation", "test"]
SEED = 42
N_FOLDS = 5

TICKET_SCHEMA = (
    "ID string, texte string, titre string, categorie string, urgence string, "
    "temps_resolution double, type_ticket string, nb_mots int"
)
BALANCED_SCHEMA = TICKET_SCHEMA + ", text_full string"
DOCUMENT_SCHEMA = "id string, text string, metadata map<string,string>"

# Columns each training stage adds to the balanced table, in order.
STAGE_COLUMNS = {
    "urgence": ["urgence_pred"],
    "categorie": ["urgence_pred", "categorie_pred"],
    "type": ["urgence_pred", "categorie_pred", "type_ticket_pred"],
}
