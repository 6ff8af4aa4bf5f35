from __future__ import annotations

from starmart.plans import sqlfunctions


def test_every_function_and_parameter_says_when_to_use_it():
    functions = sqlfunctions.table_functions()
    assert len(functions) == 7
    for function in functions:
        assert "Úsala" in function.comment and "'" not in function.comment
        assert all(p.comment and "'" not in p.comment for p in function.parameters)
        assert all("sin pedirlo" in p.comment for p in function.parameters if p.default)
