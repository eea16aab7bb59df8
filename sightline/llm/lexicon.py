"""Terms of subjects in English, German and Spanish, with weights.

Written from the general vocabulary of each subject (what indexes of textbooks and subject headings of libraries
list), without reading a corpus for it.  `core` terms name the subject or belong to it alone (weight 3), `plain` ones are usual in
it (2), `loose` ones are used elsewhere too (1).  A term may stand under several subjects.  Inflected forms are made
by rule; accents don't count.
"""

from __future__ import annotations

WEIGHTS = {"core": 3.0, "plain": 2.0, "loose": 1.0}

TERMS: dict[str, dict[str, str]] = {
    "astronomy": {
        "core": """astronomy, astronomer, astrophysics, astrophysical, galaxy, galactic, telescope, supernova, supernovae, pulsar, quasar, exoplanet, nebula, nebulae, redshift, black hole, neutron star, white dwarf, brown dwarf,
            dark matter, dark energy, cosmology, cosmological, interstellar, intergalactic, asteroid, comet, constellation, light year, parsec, stellar, star cluster, globular cluster, accretion disk, accretion disc, spectrograph,
            planetary system, solar system, milky way, cosmic microwave background, gravitational lens, gravitational wave, photometry, parallax, ecliptic, declination, right ascension, observatory, main sequence, meteor, meteorite,
            astronomie, galaxie, teleskop, sternhaufen, rotverschiebung, schwarzes loch, neutronenstern, weisser zwerg, zwergstern, milchstrasse, sonnensystem, sternwarte, komet, asteroid, lichtkurve, dunkle materie, umlaufbahn, spektrallinie,
            astronomia, galaxia, telescopio, cumulo estelar, corrimiento al rojo, agujero negro, estrella de neutrones, enana blanca, via lactea, sistema solar, observatorio, cometa, asteroide, curva de luz, materia oscura, exoplaneta""",
        "plain": """star, planet, planetary, moon, lunar, orbit, orbital, eclipse, magnitude, luminosity, starlight, spectral line, spectroscopy, light curve, transit, halo, accretion, cosmic ray, cosmic, solar wind, sunspot, interferometer,
            radio source, brightness, binary star, proper motion, celestial, aperture, stern, planet, mond, sonne, helligkeit, spektrum, finsternis, leuchtkraft, bahn, kosmisch, weltall, estrella, planeta, luna, sol, orbita, brillo, eclipse, luminosidad, linea espectral, cosmico, espacio""",
        "loose": "field, nucleus, plasma, disk, dust, cluster, survey, instrument, detector, background, dwarf, jet, burst, flux",
    },
    "biology": {
        "core": """biology, biologist, biological, gene, genetic, genome, genomic, chromosome, allele, phenotype, genotype, enzyme, protein, mitochondria, mitochondrion, mitochondrial, ribosome, photosynthesis, ecosystem, ecology, ecological,
            habitat, species, organism, mutation, natural selection, evolution, evolutionary, gene expression, transcription factor, cell membrane, cell division, predator, prey, pollinator, pollination, larva, larvae, plankton, fungus, fungi,
            fungal, spore, symbiont, symbiosis, symbiotic, taxonomy, phylogeny, phylogenetic, biodiversity, species richness, invertebrate, vertebrate, mammal, insect, bacterium, bacterial, microbial, metabolism, embryo, amino acid, dna, rna, chloroplast, stem cell,
            biologie, gen, genom, chromosom, enzym, zellmembran, artenvielfalt, lebensraum, okosystem, bestauber, larve, zellkern, raubtier, fotosynthese, stoffwechsel, erbgut, proteina, biologia, cromosoma, enzima, genoma, habitat, ecosistema, polinizador, membrana celular, mutacion, fotosintesis, depredador, biodiversidad""",
        "plain": """cell, cellular, tissue, nesting, breeding, foraging, forage, migration, host range, seedling, pollen, flower, leaf, seed, plant, animal, bird, fish, egg, morphology, niche, population, reproduction, protein folding, folding,
            receptor, membrane, virus, parasite, invasive, forest, zelle, art, pflanze, tier, vogel, organismus, vererbung, blute, samen, evolution, especie, celula, planta, animal, ave, organismo, semilla, flor, larva""",
        "loose": "culture, root, tree, stem, nucleus, branch, colony, growth, host, strain, expression, sequence, wing, food web",
    },
    "chemistry": {
        "core": """chemistry, chemist, chemical, catalyst, catalysis, catalytic, reagent, solvent, ligand, isomer, nucleophile, electrophile, nucleophilic, enthalpy, stoichiometry, stoichiometric, titration, chromatography, electrolyte, electrolysis,
            oxidation state, oxidation, hydrolysis, polymerisation, polymerization, precipitate, distillation, distillate, absorbance, molar, molar mass, covalent bond, hydrogen bond, ionic, anion, cation, chelate, reflux, mass spectrum, mass spectrometry,
            nuclear magnetic resonance, aqueous, solubility, reaction rate, reaction yield, organic synthesis, functional group, aromatic, benzene, alkane, alkene, ester, aldehyde, ketone, amine, activation energy, periodic table, molecule, molecular orbital,
            chemie, katalysator, losungsmittel, elektrolyt, reagenz, oxidationsstufe, saure, molekul, reaktionsgeschwindigkeit, ausbeute, quimica, catalizador, disolvente, electrolito, reactivo, ligando, isomero, acido, molecula, precipitado, titulacion, estado de oxidacion, oxidacion""",
        "plain": """acid, acidic, base, alkaline, reaction, compound, synthesis, synthesise, mixture, concentration, dilute, buffer, salt, metal ion, ion, ph value, redox, crystallisation, crystallization, evaporate, product yield, equilibrium constant, atom, hydrogen, oxygen,
            nitrogen, carbon dioxide, chloride, losung, reaktion, verbindung, ion, atom, stoff, basis, konzentration, gemisch, reaccion, compuesto, disolucion, mezcla, atomo, rendimiento, concentracion, sal, sintesis""",
        "loose": "solution, bond, charge, crystal, nucleus, yield, phase, substance, residue, spectrum, isotope, purity, flask",
    },
    "climate": {
        "core": """climate, climatic, climatology, meteorology, meteorological, precipitation, rainfall, drought, monsoon, glacier, glacial, permafrost, ice sheet, sea ice, sea level, sea surface temperature, greenhouse gas, greenhouse effect, global warming, climate change,
            albedo, aerosol, troposphere, stratosphere, cyclone, hurricane, typhoon, storm track, radiative forcing, ocean heat, el nino, snow cover, snowpack, heat wave, heatwave, humidity, carbon flux, carbon cycle, evapotranspiration, reanalysis, atmospheric,
            atmosphere, upwelling, wind stress, cloud cover, paleoclimate, weather forecast, weather, warming, klima, niederschlag, durre, gletscher, meeresspiegel, treibhausgas, hitzewelle, luftfeuchte, luftfeuchtigkeit, strahlungsantrieb, eisschild, wetter, erderwarmung, permafrost, atmosphare,
            clima, climatico, precipitacion, sequia, glaciar, nivel del mar, efecto invernadero, gas de efecto invernadero, ola de calor, humedad, monzon, casquete de hielo, calentamiento global, meteorologia, atmosfera, aerosol""",
        "plain": """rain, snow, wind, cloud, storm, flood, ocean, temperature, evaporation, runoff, emission, carbon, thermal, season, seasonal, arctic, antarctic, moisture, fog, frost, front, ice, regen, schnee, sturm, wolke, ozean, temperatur, emission, eis, lluvia, nieve, viento, nube, tormenta, oceano, temperatura, hielo, emisiones""",
        "loose": "circulation, front, forcing, basin, anomaly, trend, scenario, current, radiation, coast",
    },
    "economics": {
        "core": """economics, economist, economic, economy, inflation, unemployment, monetary policy, fiscal policy, central bank, interest rate, exchange rate, price elasticity, elasticity, gross domestic product, labour market, labor market, household income, consumer demand,
            supply shock, aggregate demand, trade balance, tariff, subsidy, taxation, tax incidence, public debt, portfolio, credit risk, market share, equilibrium price, wage, productivity, auction, bargaining, monopoly, oligopoly, marginal cost, utility function, macroeconomic, microeconomic,
            recession, capital market, stock market, fiscal, wirtschaft, volkswirtschaft, okonomie, arbeitslosigkeit, arbeitsmarkt, geldpolitik, fiskalpolitik, zentralbank, wechselkurs, zinssatz, staatsschuld, nachfrage, lohn, economia, inflacion, desempleo, mercado laboral, politica monetaria, banco central,
            tipo de cambio, tipo de interes, deuda publica, arancel, salario, demanda, impuesto, subsidio""",
        "plain": """market, price, money, bank, trade, investment, investor, tax, firm, income, consumer, producer, supply, demand, debt, loan, budget, export, import, rent, profit, cost, currency, welfare, finance, financial, markt, preis, geld, handel, investition, steuer, unternehmen, einkommen, angebot, zoll, haushalt, mercado, precio, dinero, comercio, inversion, empresa, ingreso, oferta, gasto""",
        "loose": "bond, equity, utility, firm, capital, labour, good, shock, share, risk, growth, incentive, return",
    },
    "law": {
        "core": """law, lawyer, legal, court, statute, statutory, plaintiff, defendant, jurisdiction, litigation, tort, negligence, liability, contract law, contract clause, breach of contract, injunction, appellate, appellate court, supreme court, judicial, judicial review, judge, jury, due process,
            burden of proof, constitutional, constitution, legislature, legislation, precedent, case law, common law, copyright, damages, verdict, arbitration, treaty, prosecutor, criminal law, civil law, human rights, testimony, felony, hearsay, remedy, attorney, recht, gesetz, gericht, klager, beklagte, urteil, haftung,
            schadenersatz, gerichtsbarkeit, beweislast, berufung, grundrecht, verfassung, vertragsklausel, rechtsprechung, staatsanwalt, richter, derecho, ley, tribunal, demandante, demandado, sentencia, responsabilidad civil, carga de la prueba, jurisdiccion, indemnizacion, apelacion, clausula, constitucion, juez, jurisprudencia""",
        "plain": """appeal, contract, clause, rule of evidence, ruling, trial court, witness, crime, criminal, regulation, privacy, rights, procedure, settlement, obligation, property right, sanction, compliance, vertrag, klage, anwalt, zeuge, strafe, eigentum, verordnung, contrato, demanda judicial, abogado, testigo, delito, pena, norma""",
        "loose": "charge, claim, party, title, trust, evidence, complaint, article, provision, duty, consent, hearing",
    },
    "linguistics": {
        "core": """linguistics, linguist, linguistic, grammar, grammatical, syntax, syntactic, morpheme, morphological, phoneme, phonology, phonological, phonetics, phonetic, vowel, vowel harmony, consonant, syllable, prosody, dialect, loanword, inflection, clitic, suffix, prefix, noun phrase, verb phrase, relative clause,
            word order, case marking, native speaker, bilingual, bilingualism, semantics, pragmatics, discourse particle, orthography, lexicon, lexical, etymology, tone sandhi, creole, noun, verb, adjective, pronoun, plural suffix, sprachwissenschaft, linguistik, grammatik, phonem, silbe, vokal, mundart, lehnwort, muttersprache, satzbau, relativsatz,
            wortstellung, lautwandel, beugung, lautverschiebung, linguistica, gramatica, fonema, silaba, dialecto, prestamo lexico, hablante nativo, oracion relativa, orden de palabras, sintaxis, sufijo, vocal, morfema""",
        "plain": """language, word, sentence, speech, speaker, utterance, accent, pronunciation, translation, discourse, vocabulary, plural, tense, verb form, phrase, clause, meaning, spoken, sprache, wort, satz, laut, aussprache, sprecher, bedeutung, lengua, idioma, palabra, oracion, hablante, pronunciacion, significado, frase""",
        "loose": "agreement, mood, root, stem, subject, tree, morphology, tone, particle, gender, number, aspect, corpus",
    },
    "mathematics": {
        "core": """mathematics, mathematical, mathematician, theorem, lemma, corollary, conjecture, manifold, algebra, algebraic, topology, topological, topological space, homomorphism, isomorphism, bijection, bijective, injective, surjective, eigenvalue, eigenvector, cohomology, homology, functor, category theory, banach space, hilbert space,
            vector space, prime number, prime ideal, polynomial, polynomial ring, holomorphic, meromorphic, differential equation, compact set, fixed point, isometry, convergence, integer, number theory, group theory, abelian, finite field, measure theory, lebesgue, inequality, axiom, geometry, geometric, mathematik, hilfssatz, lemma, vermutung,
            mannigfaltigkeit, eigenwert, primideal, polynomring, banachraum, fixpunkt, konvergenz, beweis, vektorraum, primzahl, matematica, teorema, lema, conjetura, variedad, valor propio, ideal primo, anillo de polinomios, espacio de banach, punto fijo, convergencia, demostracion, numero primo, espacio vectorial""",
        "plain": """proof, integral, derivative, matrix, vector, subset, continuous function, bounded, infinite, topology, equation, dimension, orthogonal, symmetric, converge, sequence of functions, number, set, gleichung, menge, zahl, funktion, matrix, ecuacion, conjunto, numero, funcion, matriz, algebra""",
        "loose": "field, group, kernel, ring, bundle, lattice, root, series, partition, tree, measure, norm, ideal, domain, graph, limit, space",
    },
    "medicine": {
        "core": """medicine, medical, patient, clinical, clinician, physician, diagnosis, diagnostic, therapy, therapeutic, placebo, randomised trial, randomized trial, randomised controlled trial, clinical trial, treatment arm, dosage, symptom, disease, chronic disease, mortality, morbidity, comorbidity, vaccine, vaccination, tumour, tumor, cancer,
            antibiotic, surgery, surgical, biomarker, blood pressure, hospital, hospital admission, adverse event, infection, relapse, remission, pathology, epidemiology, oncology, cardiac, diabetes, hypertension, nurse, nursing, screening, prognosis, cohort study, clinical outcome, medizin, patient, krankheit, diagnose, therapie, impfstoff, blutdruck, krankenhaus, nebenwirkung,
            sterblichkeit, dosierung, tumor, infektion, behandlung, arzt, medicina, paciente, enfermedad, diagnostico, terapia, vacuna, presion arterial, efecto adverso, mortalidad, dosis, infeccion, tratamiento, cirugia, ensayo clinico""",
        "plain": """treatment, dose, drug, cohort, health, healthy, blood, heart, lung, kidney, liver, brain, pain, fever, immune, injury, acute, chronic, outcome, incidence, survival, risk factor, medication, gesundheit, herz, schmerz, blut, medikament, klinik, salud, corazon, dolor, sangre, medicamento, clinica, sintoma""",
        "loose": "cell, culture, plasma, stroke, trial, arm, admission, episode, lesion, intervention, care",
    },
    "software": {
        "core": """software, source code, compiler, debugger, debugging, garbage collector, garbage collection, refactoring, unit test, code review, stack trace, memory leak, static analysis, type checker, type system, virtual machine, operating system, thread pool, race condition, race detector, deadlock, mutex, api, repository, deployment, bug report, bug, fuzzing, fuzzer,
            open source, programming language, programmer, software engineering, regression test, continuous integration, dependency graph, package manager, query planner, database, cache miss, buffer overflow, runtime, bytecode, concurrency, multithreaded, javascript, python, sql, web server, algorithmic, data structure, unit testing, software engineer, programmierung, quelltext, ubersetzer,
            speicherleck, laufzeit, fehlerbericht, modultest, programmierschnittstelle, virtuelle maschine, codeprufung, softwareentwicklung, betriebssystem, datenbank, paket, abhangigkeit, codigo fuente, compilador, depurador, fuga de memoria, prueba unitaria, maquina virtual, tiempo de ejecucion, informe de errores, interfaz de programacion, programacion, base de datos, sistema operativo""",
        "plain": """code, program, developer, function call, library, server, client, thread, cache, patch, version, test suite, module, parser, script, interface, memory, file system, user interface, crash, commit, release, process scheduler, stack, queue, latency, programm, software, entwickler, speicher, server, fehler, schnittstelle, programa, desarrollador, memoria, servidor, biblioteca, error""",
        "loose": "branch, bundle, kernel, lock, match, root, tree, package, build, dependency, pointer, request, object, class",
    },
    "sport": {
        "core": """sport, athlete, athletic, tournament, championship, league, coach, referee, goalkeeper, midfielder, striker, marathon, sprint, sprinter, swimmer, swimming, endurance training, training load, warm-up, heart rate, stride length, jump height, penalty kick, penalty shootout, tennis, tennis serve, football, basketball, rugby, cricket, cyclist, olympic,
            stadium, hamstring, hamstring injury, relay race, playoff, gymnastics, athlet, sportler, turnier, meisterschaft, liga, schiedsrichter, torwart, trainer, ausdauertraining, herzfrequenz, fussball, mannschaft, wettkampf, stadion, sprint, deporte, deportista, atleta, torneo, campeonato, arbitro, portero, entrenador, frecuencia cardiaca, carrera de velocidad, futbol, entrenamiento""",
        "plain": """team, player, match, game, training, race, runner, running, fitness, competition, goal, score, injury, exercise, muscle, opponent, medal, season, throw, jump, relay, pitch, strength, sprinting, spieler, spiel, tor, training, verletzung, muskel, laufer, sieg, equipo, jugador, partido, entrenar, carrera, lesion, musculo, gol""",
        "loose": "court, field, pitch, stroke, season, serve, record, ball, club, performance, ranking, pace, lap",
    },
    "materials": {
        "core": """materials science, alloy, steel, ceramic, polymer, polymer matrix, composite, composite laminate, laminate, corrosion, annealing, sintering, grain boundary, microstructure, dislocation, tensile test, tensile strength, yield strength, fracture toughness, fatigue crack, elastic modulus, ductility, ductile, brittle, hardness, porosity, thin film, nanoparticle, phase diagram, creep,
            weld, welding, coating, metallurgy, metallurgical, quenching, martensite, austenite, crystallography, viscoelastic, titanium, aluminium alloy, fibre reinforced, plastic deformation, stainless steel, filler, werkstoff, legierung, stahl, keramik, korrosion, gefuge, korngrenze, streckgrenze, zugversuch, ermudungsriss, harte, verbundwerkstoff, zugfestigkeit, bruchzahigkeit,
            material compuesto, aleacion, acero, ceramica, corrosion, dureza, limite elastico, limite de grano, ensayo de traccion, grieta por fatiga, microestructura, soldadura, polimero, tenacidad""",
        "plain": """metal, fibre, fiber, crack, fracture, fatigue, stiffness, toughness, deformation, specimen, load bearing, mechanical, elastic, tensile, wear, melt, casting, surface finish, modulus, metall, faser, riss, bruch, probe, festigkeit, material, metal, fibra, grieta, fractura, resistencia, deformacion, probeta""",
        "loose": "crystal, lattice, strain, stress, yield, grain, film, phase, sample, matrix, layer",
    },
}

# Words of descriptions that tell nothing of a subject.
COMMON = frozenset("and the that them their they this these those with from into over under about which what when where other others such also very more most some many each every both pure general".split())
