"""Small Column helpers shared by the operators."""
