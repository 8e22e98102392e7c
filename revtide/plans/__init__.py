"""How the tables depend on each other, and the registered queries."""
