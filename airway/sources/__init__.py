"""airway.sources"""
