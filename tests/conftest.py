import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from guichet.session import forget, local_session, ship_code  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(8)
    s.sparkContext.setLogLevel("ERROR")
    ship_code(s)
    yield s
    forget(s)
    s.stop()


@pytest.fixture(scope="session")
def corpus(spark):
    """Workshop notes on bicycles and bread, with ragged metadata."""
    from guichet.sources.corpus import documents_from_records

    notes = {
        "pneu": ("Regonfler un pneu de vélo : trois bars en ville, quatre sur route sèche.", {"atelier": "velo", "outil": "pompe"}),
        "chaine": ("Dégraisser la chaîne avec un chiffon, la sécher, poser une goutte d'huile par maillon.", {"atelier": "velo"}),
        "levain": ("Nourrir le levain chaque matin de farine de seigle et d'eau tiède.", {"atelier": "pain", "duree": "jour"}),
        "petrir": ("Pétrir la pâte dix minutes, puis la laisser pousser sous un linge humide.", {"atelier": "pain"}),
        "selle": ("Régler la hauteur de selle : talon posé sur la pédale, jambe tendue.", {"atelier": "velo", "outil": "clé"}),
        "four": ("Préchauffer le four avec la pierre, jeter un verre d'eau pour la buée.", {}),
    }
    return documents_from_records(spark, [{"id": name, "text": text, "metadata": metadata} for name, (text, metadata) in notes.items()])
