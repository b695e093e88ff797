"""Compositions of operators: fact and dimension loads, refresh jobs, registered queries."""
