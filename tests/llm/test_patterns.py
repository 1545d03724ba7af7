from lexloom.llm import toxicity


def test_patterns_are_tried_wherever_they_match():
    for text in ("You are a moron.", "You're such a clown", "and you are an idiot", "YOU ARE A MORON, YOU SEE", "go away!!!", "what a m**on"):
        for name, (_, pattern) in toxicity.PATTERNS.items():
            assert toxicity.pattern_found(name, text) == (pattern.search(text) is not None)
    assert toxicity.pattern_found("address", "You are a moron.")
