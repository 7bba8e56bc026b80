import inspect
import re

import pytest

from lumencube.plans import recipes, vocabulary
from lumencube.plans.vocabulary import CUBES, DIMENSIONS, LISTS, PROPERTIES, Vocabulary


def test_recipes_use_no_other_names():
    source = inspect.getsource(recipes)
    used = set(re.findall(r'\bv\("([\w-]+)"\)', source)) - {vocabulary.AREA_ITALY}
    used = {n for n in used if not n.endswith("-")} | set(recipes.MEASURES.values())
    assert used == set(PROPERTIES.values())
    assert tuple(re.findall(r'emit\("([\w-]+)"', source)) == CUBES == tuple(recipes.ABOUT)


def test_names_are_iris_under_the_base():
    v = Vocabulary("http://ex/")
    assert v.property("year") == "http://ex/annoRiferimento" and v.cube("incomes") == "http://ex/incomes" and v.structure("incomes") == "http://ex/dsd-incomes"
    assert v.concepts("regime")["RETR"] == "http://ex/regime-retributivo" and v.concepts("management")["PUB"] == "http://ex/gestione-pubblici"
    assert set(LISTS) <= set(DIMENSIONS) and len(set(PROPERTIES.values())) == len(PROPERTIES)
    for ask in (v.property, v.cube, v.structure, v.concepts):
        with pytest.raises(KeyError):
            ask("none")
