import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pithy.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="pithy-tests-")
    session = local_session(cores=8, shuffle_partitions=4, config={
        "spark.checkpoint.dir": f"{folder}/checkpoint", "spark.sql.warehouse.dir": f"{folder}/warehouse",
    })
    yield session
    session.stop()


ROWS = [
    (1, "wire", "A city council approved a new tram line on Tuesday. The line links the harbour with the "
        "airport. Building starts in spring. Fares stay as they are.",
        "The council approved a tram line from the harbour to the airport."),
    (2, "wire", "Heavy snow closed two mountain passes overnight. Crews cleared the lower road by noon. "
        "Drivers were told to carry chains. More snow is expected. Schools stay open.",
        "Snow closed two mountain passes and more is expected."),
    (3, "desk", "A museum returned three bronze statues to their owners. The statues had been lent in 1950. "
        "Dr. Lee signed the papers. The U.S. Embassy welcomed it.",
        "A museum returned three bronze statues lent in 1950."),
    (4, "desk", "The river festival drew record crowds. Boats raced until dusk. Food stalls sold out early.",
        "Record crowds came to the river festival."),
    (5, "wire", "Two towns merged their libraries. Readers keep both cards. Opening hours grow by a third. "
        "The merged library lends tools too. Staff numbers stay the same. A cafe opens in May.",
        "Two towns merged their libraries and extended opening hours."),
    (6, None, "Engineers tested a quieter train brake. The brake cuts noise by half. Tests go on.",
        "A quieter train brake cuts noise by half."),
    (7, "desk", "A bakery won the national bread prize. Its rye loaf impressed the jury. Queues formed at once.",
        "A bakery won the bread prize with a rye loaf."),
    (8, "wire", "Volunteers planted nine thousand trees. The trees protect the hillside. Saplings came from a "
        "local nursery. Watering lasts all summer.",
        "Volunteers planted nine thousand trees to protect the hillside."),
]


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.createDataFrame(ROWS, "id long, source string, article string, highlights string")
