"""Reading feeds and dimensions, writing outputs, run audit."""
